"""Networks: gradients against finite differences, distributed sums, stopping, repeatability."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from retentio.operators import network as NN
from retentio.operators.models import ChurnModel, create_model


def rows(n=300, seed=5, width=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    y = ((x[:, 0] * x[:, 1] + x[:, 2] + 0.3 * rng.normal(size=n)) > 0).astype(float)
    return x, y, rng.choice([1.0, 3.0], n), rng.random(n) < 0.25


def frame(spark, x, y, w, val):
    return spark.createDataFrame([(Vectors.dense(a), float(b), float(c), bool(d)) for a, b, c, d in zip(x, y, w, val)],
                                 ["features", "label", "weight", "held"])


def test_gradients_equal_finite_differences():
    x, y, w, _ = rows(40)
    rng = np.random.default_rng(0)
    for kind, hidden, steps in (("dense", [5, 4], 1), ("recurrent", [5], 3)):
        shapes = NN._shapes(kind, 6, hidden, steps)
        flat = NN.initial(shapes, 3) + rng.normal(size=len(NN.initial(shapes, 3))) * 0.1
        masks = [(rng.random((40, n)) >= 0.3) / 0.7 for n in hidden]
        run = (lambda v: NN.dense(NN.split_params(v, shapes), x, y, w, masks)) if kind == "dense" else \
            (lambda v: NN.recurrent(NN.split_params(v, shapes), x, y, w, 3))
        grad = np.concatenate([g.ravel() for g in run(flat)[1]])
        for i in rng.choice(len(flat), 25, replace=False):
            e = np.zeros(len(flat))
            e[i] = 1e-6
            assert np.isclose(grad[i], (run(flat + e)[0] - run(flat - e)[0]) / 2e-6, rtol=1e-4, atol=1e-5)


def test_distributed_sums_equal_one_pass(spark, monkeypatch):
    monkeypatch.setattr(NN, "CHUNK", 7)
    x, y, w, val = rows()
    df = frame(spark, x, y, w, val).select(NN.vector_to_array("features").alias("x"), F.col("label").alias("y"),
                                           F.col("weight").alias("w"), F.col("held").alias("val")).repartition(4)
    p = {"kind": "dense", "dropout": 0.0, "hidden": [5], "seed": 1, "steps": 1}
    shapes = NN._shapes("dense", 6, [5], 1)
    flat = NN.initial(shapes, 2)
    g, loss, weight, held, held_weight = NN._gradient(df, flat, shapes, p, 6, 0)
    want, grads = NN.dense(NN.split_params(flat, shapes), x[~val], y[~val], w[~val])
    assert np.allclose(g, np.concatenate([v.ravel() for v in grads])) and np.isclose(loss, want)
    assert np.isclose(weight, w[~val].sum()) and np.isclose(held_weight, w[val].sum())
    z = NN.dense(NN.split_params(flat, shapes), x[val])
    assert np.isclose(held, NN._outer_loss(z, y[val], w[val])[0])


def test_fit_learns_stops_and_repeats(spark, tmp_path):
    x, y, w, val = rows(400)
    df = frame(spark, x, y, w, val)
    make = lambda **k: NN.NetworkClassifier(validationIndicatorCol="held", weightCol="weight", hidden=[16, 8],     # noqa: E731
                                            stepSize=0.05, maxIter=30, patience=4, **k)
    model = make(dropout=0.2).fit(df)
    curve = model.history()
    assert curve[-1][1] < curve[0][1] and min(c[2] for c in curve) < curve[0][2]
    again = make(dropout=0.2).fit(df)
    assert again.getOrDefault("parameters") == model.getOrDefault("parameters")
    p = np.array([r[0][1] for r in model.transform(df).select("probability").collect()])
    assert np.mean((p >= 0.5) == (y == 1)) > 0.75
    held = NN._outer_loss(np.log(p[val] / (1 - p[val])), y[val], w[val])[0] / w[val].sum()
    assert np.isclose(held, min(c[2] for c in curve), atol=1e-6)               # the best parameters are kept
    model.write().overwrite().save(str(tmp_path / "net"))
    assert NN.NetworkModel.load(str(tmp_path / "net")).transform(df).select("probability").collect() == \
        model.transform(df).select("probability").collect()


def test_recurrent_and_edges(spark, tmp_path):
    x, y, w, val = rows(200)
    df = frame(spark, x, y, w, val)
    model = NN.NetworkClassifier(kind="recurrent", hidden=[8], steps=3, stepSize=0.05, maxIter=15).fit(df)
    assert model.history()[-1][1] < model.history()[0][1] and model.history()[0][2] is None
    assert model.transform(df.limit(0)).count() == 0
    for bad in (NN.NetworkClassifier(kind="recurrent", steps=4), NN.NetworkClassifier(kind="other")):
        with pytest.raises(ValueError):
            bad.fit(df)
    with pytest.raises(ValueError):
        NN.NetworkClassifier().fit(df.limit(0))
    plain = spark.createDataFrame([(i, float(a[0]), None if i % 9 == 0 else float(a[1]), int(k)) for i, (a, k) in enumerate(zip(x, y))],
                                  "id long, a double, b double, label int")
    churn = create_model("neural_network", ["a", "b"], "label", hidden=[4], maxIter=5).fit(plain.fillna(0.0))
    churn.save(str(tmp_path / "churn"))
    first = churn.predict_proba(plain.fillna(0.0), ["id"]).orderBy("id").collect()
    assert ChurnModel.load(str(tmp_path / "churn")).predict_proba(plain.fillna(0.0), ["id"]).orderBy("id").collect() == first
    assert len(churn.training_curve()) == 6


def test_arrow_columns_give_the_same_matrix():
    import pandas as pd
    import pyarrow as pa
    values = [[1.0, None, 3.0], [float("nan"), 5.0, 6.0], [7.0, 8.0, None], [0.5, 0.25, 0.125]]
    column = pa.array(values, pa.list_(pa.float64()))
    for part in (column, column.slice(1, 2), column.slice(4)):
        want = NN._matrix(pd.Series(part.to_pylist(), dtype=object), 3) if len(part) else np.zeros((0, 3))
        assert np.array_equal(NN._arrow_matrix(part, 3), want)
