"""Grouped logistic regression and the time-series chain against direct computations; selection and
resampling cases that lost precision or rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentio.operators import features as FE
from retentio.operators import irls, select as SE, smote as SM, timeseries as TS


def newton(x, y, ridge=1.0):
    x = np.column_stack([np.ones(len(y)), x])
    pen = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    b = np.zeros(x.shape[1])
    for _ in range(60):
        mu = 1 / (1 + np.exp(-x @ b))
        g = x.T @ (y - mu) - pen @ b
        b = b + np.linalg.solve((x * (mu * (1 - mu))[:, None]).T @ x + pen, g)
    return b


def panel_rows(n=40, periods=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        for t in range(1, rng.integers(1, periods + 1) + 1):
            a, b = float(rng.normal()), float(rng.integers(0, 4))
            rows.append((i, int(t), a, b, int(rng.random() < 1 / (1 + np.exp(-(a - 0.4 * b))))))
    return rows + [(900, 50, 1.0, 2.0, 1), (901, 50, 0.0, 1.0, 1)]       # a period with one class


SCHEMA = "id long, t int, a double, b double, label int"
BASES = {"first": ["a"], "second": ["a", "b"]}


def test_grouped_fits_equal_single_fits(spark):
    rows = panel_rows()
    out = irls.fit_groups(spark.createDataFrame(rows, SCHEMA), "t", ["a", "b"], "label").collect()
    assert {r["t"] for r in out} == {1, 2, 3, 4, 5, 6}
    for r in out:
        mine = [x for x in rows if x[1] == r["t"]]
        want = newton(np.array([x[2:4] for x in mine]), np.array([x[4] for x in mine], float))
        assert r["n"] == len(mine) and np.allclose([r["b0"], r["b1"], r["b2"]], want, atol=1e-7)


def test_fits_of_hard_groups(spark):
    # separable, constant, large-valued, NULL features and labels, a group with a third of the rows
    rows = [(1, 0, float(i), 0.0, int(i > 10)) for i in range(20)] + [(2, 1, 7.0, 7.0, i % 2) for i in range(20)]
    rows += [(3, 2, 1e4 * i, None, i % 3 == 0) for i in range(30)] + [(4, None, 1.0, 1.0, 1), (5, 2, 1.0, 1.0, None)]
    rows = [(i, t, a, b, None if y is None else int(y)) for i, t, a, b, y in rows]
    out = {r["t"]: r for r in irls.fit_groups(spark.createDataFrame(rows, SCHEMA), "t", ["a", "b"], "label").collect()}
    assert set(out) == {0, 1, 2} and out[2]["n"] == 30
    for t, r in out.items():
        mine = [x for x in rows if x[1] == t and x[4] is not None]
        x = np.array([[v or 0.0 for v in m[2:4]] for m in mine])
        y = np.array([m[4] for m in mine], float)
        b = np.array([r["b0"], r["b1"], r["b2"]])
        mu = 1 / (1 + np.exp(-(b[0] + x @ b[1:])))
        grad = np.array([(y - mu).sum(), *(x.T @ (y - mu) - b[1:])])
        assert np.allclose(grad / (1 + np.abs(x).sum(0).max()), 0, atol=1e-6)
    assert irls.fit_groups(spark.createDataFrame([], SCHEMA), "t", ["a"], "label").count() == 0


def test_chain_equals_direct_computation(spark, tmp_path):
    rows = panel_rows()
    panel = spark.createDataFrame(rows, SCHEMA)
    model = TS.fit(panel, "id", "t", BASES, "label", window=3)
    sig = lambda b, x: 1 / (1 + np.exp(-(b[0] + np.dot(b[1:], x))))                      # noqa: E731
    cols = {"first": [0], "second": [0, 1]}
    per = {(t, m): newton(np.array([x[2:4] for x in rows if x[1] == t])[:, cols[m]], np.array([x[4] for x in rows if x[1] == t], float))
           for t in range(1, 7) for m in BASES}
    customers = {}
    for i, t, a, b, y in sorted(rows):
        p = [sig(per[t, m], np.array([a, b])[cols[m]]) if (t, m) in per else 0.0 for m in BASES]
        customers.setdefault(i, []).append((t, a, b, y, p))
    windows = [(np.concatenate([r[4] for r in c[k:k + 3]]), c[k + 3][3]) for c in customers.values() for k in range(len(c) - 3)]
    seq = newton(np.array([w for w, _ in windows]), np.array([y for _, y in windows], float))
    assert np.allclose(model.sequence, seq, atol=1e-6)
    pooled = {m: newton(np.array([x[2:4] for x in rows])[:, cols[m]], np.array([x[4] for x in rows], float)) for m in BASES}
    got = {(r["id"], r["t"]): r["score"] for r in model.score(panel).collect()}
    coming = {(r["id"], r["period"]): r for r in model.forecast(panel, periods=3).collect()}
    for i, c in customers.items():
        p = [np.array([sig(pooled[m], np.array([a, b])[cols[m]]) for m in BASES]) for _, a, b, _, _ in c]
        for k, (t, *_) in enumerate(c):
            want = sig(seq, np.concatenate(p[k - 2:k + 1])) if k >= 2 else p[k].mean()
            assert abs(got[i, t] - want) < 1e-6
        for h in range(3):
            if len(c) < 3:
                assert (i, h + 1) not in coming
                continue
            w = (p[-3:] + [p[-1]] * h)[h:h + 3]
            assert abs(coming[i, h + 1]["forecast_prob"] - sig(seq, np.concatenate(w))) < 2e-6
            assert coming[i, h + 1]["t"] == 50 + h + 1
    assert len(got) == len(rows)
    model.save(str(tmp_path / "series"))
    again = TS.TimeSeriesModel.load(spark, str(tmp_path / "series"))
    unseen = spark.createDataFrame([(1, 70, 0.1, 1.0, 0), (1, 71, 0.2, 1.0, 0), (1, 72, 0.3, None, 0), (2, 70, 0.5, 0.0, 1)], SCHEMA)
    assert sorted(again.score(unseen).collect()) == sorted(model.score(unseen).collect())
    assert again.period_models.count() == model.period_models.count() == 6 * (2 + 3)
    both = again.history_and_forecast(unseen, unseen.where("id = 1").select("id")).collect()
    assert sorted((r["kind"], r["t"]) for r in both) == [("forecast", 73), ("forecast", 74), ("forecast", 75)] + [("history", t) for t in (70, 71, 72)]
    with pytest.raises(ValueError):
        TS.fit(panel.withColumn("label", F.lit(1)), "id", "t", BASES, "label")


def test_anova_of_large_values(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=2000)
    y = (x + rng.normal(size=2000) > 0).astype(int)
    rows = [(float(1e8 + a), float(a), int(b)) for a, b in zip(x, y)] + [(None, 0.0, 1)]
    out = {r["feature"]: r["f_score"] for r in SE.anova_f(spark.createDataFrame(rows, "big double, small double, label int"),
                                                         ["big", "small"], "label").collect()}
    g = [x[y == k] for k in (0, 1)]
    between = sum(len(v) * (v.mean() - x.mean()) ** 2 for v in g)
    within = sum(((v - v.mean()) ** 2).sum() for v in g) / (len(x) - 2)
    assert abs(out["big"] / (between / within) - 1) < 1e-4


def test_smote_keeps_its_count_with_ties_and_outliers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.integers(0, 2)), float(rng.integers(0, 3)), 1) for i in range(1500)]
    rows += [(5000 + i, 1e6 * (i + 1), -1e6 * i, 1) for i in range(12)] + [(10_000 + i, 0.5, float(i % 7), 0) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    out = SM.smote(df, "id", "label", ["a", "b"], ratio=1.0)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 6000, 1: 6000}
    nbs = SM.minority_neighbours(df.where("label = 1"), "id", ["a", "b"], 5, leaf_rows=64)
    assert [r["count"] for r in nbs.groupBy("qid").count().select("count").distinct().collect()] == [5]
    assert nbs.select("qid").distinct().count() == 1512
    few = spark.createDataFrame(rows[:2] + rows[-40:], df.schema)
    assert SM.smote(few, "id", "label", ["a", "b"]).count() == 80


def test_features_with_absent_columns(spark):
    df = spark.createDataFrame([("Yes", 5.0, -2.0), ("No", -5.0, 0.0), (None, None, 1.0)], "OwnsComputer string, PercChangeMinutes double, DroppedCalls double")
    out = FE.add_features(df, names=["TechSavvyScore", "TrendConsistency"]).collect()
    assert [r["TechSavvyScore"] for r in out] == [1, 0, 0]
    assert [r["TrendConsistency"] for r in out] == [0.0, 0.5, None]
    assert FE.available(df.select("DroppedCalls"), ["TechSavvyScore", "TrendConsistency"]) == ["TrendConsistency"]
    calls = spark.createDataFrame([(0.0, 0.0, 1.0), (0.0, None, 1.0)], "OutboundCalls double, InboundCalls double, CustomerCareCalls double")
    assert "OutboundCallRatio" not in FE.grouped_features(calls) and "TotalCalls" in FE.grouped_features(calls)
    assert "OutboundCallRatio" in FE.grouped_features(calls.withColumn("OutboundCalls", F.lit(2.0)))
