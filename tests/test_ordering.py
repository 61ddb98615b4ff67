"""Slice-wise running sums / ranks / exact quantiles against NumPy."""
import numpy as np
import pandas as pd

from retentio.plans.ordering import exact_quantiles, k_smallest, row_index, running_sum


def _frame(spark, n=500, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "g": rng.integers(0, 3, n),
                        "v": np.round(rng.normal(0, 10, n), 1), "w": rng.integers(1, 5, n)})
    pdf.loc[::17, "v"] = np.nan
    return spark.createDataFrame(pdf), pdf


def test_running_sum_matches_cumsum(spark):
    df, pdf = _frame(spark)
    out = running_sum(df, ["v", "id"], ["w"], ["g"], num_partitions=7).toPandas()
    exp = pdf.sort_values(["g", "v", "id"], na_position="first")
    exp["cum"] = exp.groupby("g")["w"].cumsum()
    got = out.set_index("id")["cum_w"]
    assert (got.loc[exp["id"]].to_numpy() == exp["cum"].to_numpy()).all()


def test_row_index_is_dense_per_group(spark):
    df, pdf = _frame(spark)
    out = row_index(df, ["id"], ["g"], num_partitions=5).toPandas()
    for g, part in out.groupby("g"):
        assert sorted(part["row_idx"]) == list(range(1, len(part) + 1))
        assert (part.sort_values("id")["row_idx"].to_numpy() == np.arange(1, len(part) + 1)).all()


def test_exact_quantiles_linear(spark):
    df, pdf = _frame(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["v", "w"], probs).toPandas().set_index("column")
    for c in ["v", "w"]:
        exp = np.quantile(pdf[c].dropna().to_numpy(), probs)
        assert np.allclose([got.loc[c, f"q{i}"] for i in range(len(probs))], exp)


def test_exact_quantiles_all_null_column(spark):
    from retentio.plans.ordering import quantile_row
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "x double, y double")
    assert exact_quantiles(df, ["x"], [0.5]).count() == 0
    assert quantile_row(df, ["x", "y"], [0.5]) == {"x": [None], "y": [2.0]}


def test_running_sum_totals_both_paths(spark):
    df, pdf = _frame(spark)
    for parts in (None, 6):
        out = running_sum(df, ["id"], ["w"], ["g"], num_partitions=parts, with_totals=True).toPandas()
        exp = pdf.groupby("g")["w"].sum()
        assert (out.groupby("g")["cum_total_w"].first() == exp).all()


def test_k_smallest(spark):
    df, pdf = _frame(spark)
    got = k_smallest(df, ["id"], 3, ["g"]).toPandas()
    for g, part in pdf.groupby("g"):
        assert sorted(got[got.g == g]["id"]) == sorted(part["id"])[:3]


def test_hot_group_is_sliced_and_exact(spark):
    """One group holds a third of the rows: it is cut into several slices (no single
    task holds it) and ranks / quantiles stay exact."""
    from pyspark.sql import functions as F

    from retentio.plans.ordering import with_slices
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n), "g": np.where(np.arange(n) % 3 == 0, 0, 1 + np.arange(n) % 50)})
    pdf["v"] = (pdf["id"] * 7919) % 1009
    df = spark.createDataFrame(pdf)
    hot = with_slices(df, "id", ["g"], num_slices=8).where("g = 0").groupBy("_slice").count().collect()
    assert len(hot) >= 6 and max(r["count"] for r in hot) <= n // 3 // 4
    ranked = row_index(df, ["id"], ["g"], num_partitions=8).where("g = 0").toPandas().sort_values("id")
    assert (ranked["row_idx"].to_numpy() == np.arange(1, n // 3 + 1)).all()
    q = exact_quantiles(df.where(F.col("g") == 0), ["v"], [0.5]).first()["q0"]
    assert q == float(np.quantile(pdf[pdf.g == 0]["v"], 0.5))


def test_null_group_and_null_key_keep_their_rows(spark):
    rows = [(i, None if i % 20 == 0 else i % 3, None if i % 7 == 0 else float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    for slices in (None, 1, 9):
        out = row_index(df, ["v", "id"], ["g"], num_partitions=slices).toPandas()
        assert len(out) == 600
        for _, part in out.groupby("g", dropna=False):
            assert sorted(part["row_idx"]) == list(range(1, len(part) + 1))
    q = {r["g"]: r["q0"] for r in exact_quantiles(df, ["v"], [0.5], by=["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"])
    assert q[None] == pdf[pdf.g.isna()]["v"].median() and q[1] == pdf[pdf.g == 1]["v"].median()


def test_quantiles_of_large_skewed_columns(spark):
    """Brackets narrower than the data: ties, infinities, one group with a third of the rows."""
    rng = np.random.default_rng(4)
    n = 60_000
    pdf = pd.DataFrame({"g": np.where(np.arange(n) % 3 == 0, 0, np.arange(n) % 5), "x": rng.normal(size=n),
                        "zeros": np.where(rng.random(n) < 0.9, 0.0, rng.normal(size=n)), "k": rng.integers(0, 4, n)})
    pdf.loc[5, "x"] = np.inf
    df = spark.createDataFrame(pdf).repartition(4)
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 0.9999, 1.0]
    got = exact_quantiles(df, ["x", "zeros", "k"], probs, by=["g"]).toPandas()
    for _, r in got.iterrows():
        exp = pdf[pdf.g == r["g"]][r["column"]].quantile(probs).to_numpy()
        have = np.array([r[f"q{i}"] for i in range(len(probs))])
        same = (have == exp) | (np.abs(have - exp) < 1e-12)
        assert same[np.isfinite(exp)].all() and r["n"] == (pdf.g == r["g"]).sum()


def test_empty_frame(spark):
    df = spark.createDataFrame([], "id long, g int, v double")
    assert row_index(df, ["id"], ["g"]).count() == 0 and row_index(df, ["id"]).count() == 0
    assert exact_quantiles(df, ["v"], [0.5]).count() == 0
