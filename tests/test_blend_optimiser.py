"""Blend weights by ascent on the simplex against a fine grid."""

import numpy as np
import pandas as pd
import pytest

from retentio.operators import blend_optimiser as BO
from retentio.operators import ensemble as EB


def _scores(spark, n=4000, seed=5):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    sig = lambda strength: 1 / (1 + np.exp(-(strength * (y - 0.5) + rng.normal(0, 1.2, n))))
    pdf = pd.DataFrame({"label": y, "a": sig(1.2), "b": sig(0.9), "c": sig(0.2)}).round(3)
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("metric", ["auc", "average_precision", "f1", "accuracy"])
def test_reaches_the_optimum_of_a_fine_grid(spark, metric):
    df = _scores(spark)
    grid = [(i / 20, j / 20, (20 - i - j) / 20) for i in range(21) for j in range(21 - i)]
    best = max(r["score"] for r in EB._blend_scores(df, ["a", "b", "c"], grid, "label", metric).collect())
    row = BO.blend_optimise(df, ["a", "b", "c"], metric=metric).first()
    w = [row["w_a"], row["w_b"], row["w_c"]]
    assert min(w) >= 0 and abs(sum(w) - 1) < 1e-9
    assert row["score"] >= best - (1e-3 if metric in ("auc", "average_precision") else 6e-3)
    again = EB._blend_scores(df, ["a", "b", "c"], [tuple(w)], "label", metric).first()["score"]
    assert abs(again - row["score"]) < 1e-9                     # the exact metric of these weights


def test_many_models_beat_every_single_one(spark):
    df = _scores(spark).selectExpr("*", "1 - a AS worse", "(a + b) / 2 AS mix")
    models = ["worse", "a", "b", "c", "mix"]
    row = BO.blend_optimise(df, models).first()
    alone = [r["score"] for r in EB._blend_scores(df, models, [tuple(map(float, v)) for v in np.eye(5)], "label", "auc").collect()]
    assert row["score"] > max(alone) and row["w_worse"] < 0.02


def test_gradient_equals_finite_differences(spark):
    df = _scores(spark, 3000)
    rows = df.groupBy("label", "a", "b", "c").count().withColumnRenamed("count", "cnt")
    w, d = np.array([0.4, 0.35, 0.25]), 0.02
    moves = [np.array(m) for m in ([1, -1, 0], [0, 1, -1], [1, 0, -1])]
    hists = BO._histograms(rows, ["a", "b", "c"], [w, *[w + s * d * m for m in moves for s in (1, -1)]], "label")
    found = [BO._value_and_gradient(h, "auc", 0.5, BO._kernel()) for h in hists]
    for i, m in enumerate(moves):
        slope = (found[1 + 2 * i][0] - found[2 + 2 * i][0]) / (2 * d)
        assert abs(found[0][1] @ m - slope) < 0.03 * max(1.0, abs(slope)) + 0.01


def test_projection_and_edge_cases(spark):
    for v in np.random.default_rng(1).normal(0, 2, (50, 4)):
        p = BO.project(v)
        assert p.min() >= 0 and abs(p.sum() - 1) < 1e-9
        assert all(np.linalg.norm(v - p) <= np.linalg.norm(v - q) + 1e-9 for q in np.random.default_rng(2).dirichlet(np.ones(4), 200))
    schema = "label int, a double, b double"
    one = spark.createDataFrame([(1, 0.2, 0.4), (1, None, 0.5), (None, 0.1, 0.1)], schema)
    for df in (one, one.limit(0)):
        row = BO.blend_optimise(df, ["a", "b"]).first()
        assert (row["w_a"], row["w_b"], row["score"]) == (0.5, 0.5, None)
    ties = spark.createDataFrame([(i % 2, 0.5, 0.5) for i in range(10)], schema)
    assert BO.blend_optimise(ties, ["a", "b"]).first()["score"] == 0.5
    with pytest.raises(ValueError):
        BO.blend_optimise(ties, ["a", "b"], metric="mse")
