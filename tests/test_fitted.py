"""The fitted preprocessing as saved pipeline stages, sparse one-hot and selection over indicators."""

import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from retentio.operators import encode as EN
from retentio.operators import fitted as FT
from retentio.operators import select as SE


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("encoding,scaling", [("one-hot", "standard"), ("label", "robust")])
def test_saved_preprocessor_equals_batch_on_a_stream(spark, sf, encoding, scaling):
    from retentio.plans.workflows import PreprocessConfig, Preprocessor
    from retentio.sources.mart import mart_table
    raw = mart_table(spark, sf, raw=True)
    train, hold = raw.where("CustomerID % 3 <> 0"), raw.where("CustomerID % 3 = 0")
    pre = Preprocessor(config=PreprocessConfig(categorical_encoding=encoding, numerical_scaling=scaling))
    pre.fit_transform(train)
    d = tempfile.mkdtemp(prefix="retentio-test-")
    pre.model().save(f"{d}/model")
    loaded = PipelineModel.load(f"{d}/model")
    batch = loaded.transform(hold)
    assert _rows(batch) == _rows(pre.model().transform(hold))
    hold.repartition(3).write.parquet(f"{d}/in")
    stream = loaded.transform(spark.readStream.schema(hold.schema).parquet(f"{d}/in"))
    q = stream.writeStream.format("parquet").option("path", f"{d}/out").option("checkpointLocation", f"{d}/ckpt") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    assert _rows(spark.read.parquet(f"{d}/out").select(*batch.columns)) == _rows(batch)


def test_saved_features_of_all_families_run_on_a_stream(spark, sf):
    from retentio.operators import features as FE
    from retentio.roles import CHURN_ROLES
    from retentio.sources.mart import mart_table
    raw = mart_table(spark, sf, raw=True)
    names = list(dict.fromkeys(n for f in FE.FAMILIES for n in FE.family_members(f)))
    d = tempfile.mkdtemp(prefix="retentio-test-")
    PipelineModel([FT.CoerceNumeric(columns=list(CHURN_ROLES.discrete)), FT.AddFeatures(names=names)]).save(f"{d}/model")
    loaded = PipelineModel.load(f"{d}/model")
    batch = loaded.transform(raw)
    assert set(names) <= set(batch.columns)
    raw.repartition(3).write.parquet(f"{d}/in")
    q = loaded.transform(spark.readStream.schema(raw.schema).parquet(f"{d}/in")).writeStream.format("parquet") \
        .option("path", f"{d}/out").option("checkpointLocation", f"{d}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    assert _rows(spark.read.parquet(f"{d}/out").select(*batch.columns)) == _rows(batch)


def test_wide_dictionaries_are_saved_and_join_a_stream(spark, monkeypatch):
    monkeypatch.setattr(EN, "MAX_LITERAL_CATEGORIES", 3)
    train = spark.createDataFrame([(i, f"v{i % 7}", f"w{i % 6}") for i in range(40)] + [(99, None, None)], "id int, a string, b string")
    hold = spark.createDataFrame([(1, "v3", "w5"), (2, "new", "w0"), (3, None, None), (4, "", "w1")], "id int, a string, b string")
    vals = EN.distinct_values(train, ["a", "b"], 3)
    assert vals == {"a": None, "b": None}
    label = EN.LabelEncoder({}, {"a": EN._dictionary(train, "a")})
    hot = EN.fit_one_hot(train, ["b"], limit=3)
    model = PipelineModel([FT.LabelCodes.of(label, {"a": "v2"}), FT.OneHot.of(hot)])
    d = tempfile.mkdtemp(prefix="retentio-test-")
    model.save(f"{d}/model")
    loaded = PipelineModel.load(f"{d}/model")
    view = lambda df: df.select("id", "a", F.unwrap_udt("b_onehot")["size"].alias("size"),
                                F.unwrap_udt("b_onehot")["indices"].alias("at"))
    got = {r["id"]: (r["a"], r["size"], r["at"]) for r in view(loaded.transform(hold)).collect()}
    # codes by string order; 'nan' (NULL) is a class of the label encoder and sorts before the v's
    assert got == {1: (4, 6, [5]), 2: (3, 6, [0]), 3: (0, 6, []), 4: (3, 6, [1])}
    hold.write.parquet(f"{d}/in")
    q = view(loaded.transform(spark.readStream.schema(hold.schema).parquet(f"{d}/in"))).writeStream.format("parquet") \
        .option("path", f"{d}/out").option("checkpointLocation", f"{d}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r["id"]: (r["a"], r["size"], r["at"]) for r in spark.read.parquet(f"{d}/out").collect()} == got


def test_sparse_one_hot_equals_the_indicator_columns(spark):
    df = spark.createDataFrame([(i, None if i % 11 == 0 else f"c{i * i % 13}") for i in range(200)], "id int, x string")
    for drop_first in (False, True):
        dense = EN.fit_one_hot(df, ["x"], drop_first)
        sparse = EN.fit_one_hot(df, ["x"], drop_first, limit=2)
        assert dense.dictionaries == {} and list(sparse.dictionaries) == ["x"] and sparse.source_of() == {"x_onehot": "x"}
        names = [n for n, _ in dense.output_columns("x")]
        want = {r["id"]: [r[n] for n in names] for r in dense.transform(df).collect()}
        assert {r["id"]: list(r["x_onehot"].toArray()) for r in sparse.transform(df).collect()} == want
    one = EN.fit_one_hot(df.withColumn("x", F.lit("only")), ["x"], True, limit=0)
    assert one.transform(df.withColumn("x", F.lit("only"))).columns == ["id"]          # nothing is left after the first
    empty = df.limit(0)
    assert EN.fit_one_hot(empty, ["x"]).transform(empty).columns == ["id"]


def test_indicator_scores_equal_the_dense_columns(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.integers(0, 9, 300).astype(str), "z": rng.integers(0, 3, 300).astype(str),
                        "u": rng.normal(1e6, 1.0, 300), "y": rng.integers(0, 3, 300)})
    pdf.loc[::17, "x"] = None
    pdf["u"] += 5 * (pdf["z"] == "1")
    df = spark.createDataFrame(pdf)
    dense = EN.fit_one_hot(df, ["x", "z"]).transform(df)
    cols = [c for c in dense.columns if c not in ("u", "y")]
    want = {r["feature"]: r["f_score"] for r in SE.anova_f(dense, cols, "y").collect()}
    got = {f"{r['source']}_{r['value']}": r["f_score"] for r in SE.indicator_f(df, ["x", "z"], "y").collect()}
    assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 2e-6 for c in want)
    plain = dense.toPandas()
    for r in SE.indicator_correlation(df, ["x", "z"], ["u"]).collect():
        assert abs(r["corr"] - np.corrcoef(plain[f"{r['source']}_{r['value']}"], plain["u"])[0, 1]) < 2e-6


def test_selection_drops_indicators_that_repeat_a_number(spark):
    df = spark.createDataFrame([(i, float(i % 2), "odd" if i % 2 else "even", f"k{i % 5}", int(i % 10 < 4 or i % 2)) for i in range(100)],
                               "id int, n double, parity string, k string, y int")
    out = [(r["source"], r["value"], r["rank"]) for r in SE.select_encoded(df, ["n"], ["parity", "k"], "y", 20).collect()]
    assert ("n", None, 1) in [(s, v, r) for s, v, r in out] and not [x for x in out if x[0] == "parity"]
    assert {v for s, v, _ in out if s == "k"} == {f"k{i}" for i in range(5)}
    one_class = df.withColumn("y", F.lit(1))
    assert SE.indicator_f(one_class, ["k"], "y").where("f_score is not null").count() == 0


def test_sparse_one_hot_keeps_no_name_a_category(spark):
    """The driver holds a column's metadata: it has to stay as small for millions of categories."""
    df = spark.createDataFrame([(i, f"k{i % 40:02d}") for i in range(80)] + [(80, None), (81, "new")], "id long, x string")
    out = EN.fit_one_hot(df.where("id < 80"), ["x"], limit=2).transform(df)
    assert out.schema["x_onehot"].metadata == {"ml_attr": {"num_attrs": 40}}
    got = {r["id"]: r["x_onehot"] for r in out.collect()}
    assert all(v.size == 40 and list(v.indices) == ([i % 40] if i < 80 else []) for i, v in got.items())
