"""Splits, folds, resampling, selection statistics."""
from pyspark.sql import functions as F

from retentio.operators import sample as SA
from retentio.operators import select as SE
from retentio.plans.moments import correlation_pairs


def _ids(spark, n=200):
    return spark.createDataFrame([(i, "Yes" if i % 4 == 0 else "No") for i in range(n)], "id long, y string")


def test_stratified_split_sizes(spark):
    out = SA.stratified_split(_ids(spark), "id", "y", 0.2)
    c = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert c[("Yes", "test")] == 10 and c[("No", "test")] == 30


def test_kfold_disjoint_and_covering(spark):
    out = SA.stratified_kfold(_ids(spark), "id", "y", 5)
    assert out.count() == 200 and out.select("id").distinct().count() == 200
    sizes = [r["count"] for r in out.groupBy("fold").count().collect()]
    assert sorted(sizes) == [40] * 5


def test_undersample_ratio_and_guard(spark):
    ids = _ids(spark)
    out = SA.undersample(ids, "id", "y", 1.0)
    c = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert c == {"Yes": 50, "No": 50}
    three = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, y string")
    assert SA.undersample(three, "id", "y").count() == 3      # not binary: unchanged


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(10)], "c double, x double")
    assert correlation_pairs(df, ["c", "x"]).first()["corr"] is None


def test_drop_correlated_compares_with_dropped_columns(spark):
    rows = [(float(i), float(i) + (0.1 if i % 2 else 0), float(i % 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out = {r["feature"]: r["dropped"] for r in SE.drop_correlated(df, ["a", "b", "c"], 0.85).collect()}
    assert out == {"a": False, "b": True, "c": False}


def test_information_value_infinite_on_perfect_split(spark):
    rows = [(float(i), 1 if i >= 50 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, label int")
    r = SE.information_values(df, ["x"], [], "label").first()
    assert r["iv"] == float("inf") and r["strength"] == "Very Strong"


def test_anova_f_matches_formula(spark):
    rows = [(1.0, 0), (2.0, 0), (3.0, 0), (6.0, 1), (7.0, 1), (8.0, 1)]
    df = spark.createDataFrame(rows, "x double, label int")
    f = SE.anova_f(df, ["x"], "label").first()["f_score"]
    # groups (1,2,3) and (6,7,8): SSB = 37.5, SSW = 4 -> F = 37.5 / (4 / 4)
    assert abs(f - 37.5) < 1e-9


def test_null_labels_string_ids_and_empty_frames(spark):
    rows = [(f"C{i}", None if i % 10 == 0 else i % 3 == 0) for i in range(300)]
    df = spark.createDataFrame([(i, None if y is None else int(y)) for i, y in rows], "id string, y int")
    for out in (SA.stratified_split(df, "id", "y", 0.2), SA.three_way_split(df, "id", "y")):
        got = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
        assert sum(got.values()) == 300 and got[(None, None)] == 30
        assert all((k[0] is None) == (k[1] is None) for k in got)
    folds = SA.stratified_kfold(df, "id", "y", 4)
    assert folds.count() == 300 and folds.where("y IS NULL AND fold IS NULL").count() == 30
    under = SA.undersample(df, "id", "y")
    assert {r["y"]: r["count"] for r in under.groupBy("y").count().collect()} == {None: 30, 0: 90, 1: 90}
    empty = df.limit(0)
    for out in (SA.stratified_split(empty, "id", "y"), SA.three_way_split(empty, "id", "y"),
                SA.stratified_kfold(empty, "id", "y"), SA.undersample(empty, "id", "y")):
        assert out.count() == 0


def test_smote_neighbours_and_other_columns(spark):
    import numpy as np

    from retentio.operators import smote as SM
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(700, 3))
    rows = [(f"i{k}", int(k < 200), *map(float, p), "x") for k, p in enumerate(pts)] + [("n", None, 0.0, 0.0, 0.0, "x")]
    df = spark.createDataFrame(rows, "id string, y int, a double, b double, c double, other string")
    nb = SM.minority_neighbours(df.where("y = 1"), "id", ["a", "b", "c"], k=4, leaf_rows=20, trees=4).toPandas()
    assert (nb.groupby("qid").size() == 4).all() and nb["qid"].nunique() == 200
    std = (pts[:200] - pts[:200].mean(0)) / pts[:200].std(0, ddof=1)
    true = np.sort(np.sqrt(((std[:, None] - std[None]) ** 2).sum(2)), axis=1)[:, 1:5]
    found = np.sort(np.stack(nb.sort_values(["qid", "nb_rank"]).groupby("qid")["dist"].apply(np.array).reindex(
        [f"i{k}" for k in range(200)]).to_list()), axis=1)
    assert found.mean() < 1.2 * true.mean() and (found >= true - 1e-9).all()
    out = SM.smote(df, "id", "y", ["a", "b", "c"])
    assert out.columns == df.columns
    new = out.where("id IS NULL").toPandas()
    assert len(new) == 300 and (new["y"] == 1).all() and new["other"].isna().all()
    assert out.where("y IS NULL").count() == 1
    low, high = pts[:200].min(0), pts[:200].max(0)
    assert (new[["a", "b", "c"]].to_numpy() >= low).all() and (new[["a", "b", "c"]].to_numpy() <= high).all()
    same = SM.smote(df, "id", "y", ["a", "b", "c"]).where("id IS NULL").toPandas()
    assert sorted(map(tuple, same[["a", "b", "c"]].to_numpy())) == sorted(map(tuple, new[["a", "b", "c"]].to_numpy()))
    tied = spark.createDataFrame([(k, int(k < 100), 1.0) for k in range(250)], "id long, y int, a double")
    assert SM.smote(tied, "id", "y", ["a"]).count() == 300
