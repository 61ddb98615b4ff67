"""Ensembles as Spark ML models: scores of unseen rows, save and load, out-of-fold meta-model."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from retentio.operators import ensemble_ml as ML
from tests.test_timeseries import newton

FEATURES = ["a", "b", "c"]
RIDGES = {"one": {"kind": ML.RIDGE, "features": ["a", "b"]}, "two": {"kind": ML.RIDGE, "features": ["c"], "ridge": 0.5}}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3))
    y = (x @ [1.0, -0.7, 0.5] + rng.normal(size=400) > 0).astype(int)
    data = [(i, *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "CustomerID long, a double, b double, c double, label int")
    return df.where("CustomerID < 300"), df.where("CustomerID >= 300").drop("label"), x[:300], y[:300], x[300:]


def sig(b, x):
    return 1 / (1 + np.exp(-(b[0] + x @ b[1:])))


def test_stacking_of_ridge_models_equals_direct_computation(spark, rows, tmp_path):
    train, unseen, x, y, new = rows
    est = ML.ChurnEnsemble(RIDGES, "stacking", folds=4, shuffle="modular")
    folds = {r["CustomerID"]: r["fold"] for r in est.out_of_fold(train).select("CustomerID", "fold").collect()}
    fold = np.array([folds[i] for i in range(300)])
    cols, ridge = {"one": [0, 1], "two": [2]}, {"one": 1.0, "two": 0.5}
    oof = np.zeros((300, 2))
    for j, b in enumerate(RIDGES):
        for f in range(4):
            w = newton(x[fold != f][:, cols[b]], y[fold != f].astype(float), ridge[b])
            oof[fold == f, j] = sig(w, x[fold == f][:, cols[b]])
    got = est.out_of_fold(train).select("CustomerID", "p_one", "p_two").orderBy("CustomerID").collect()
    assert np.allclose([[r[1], r[2]] for r in got], oof, atol=1e-6)
    meta = newton(oof, y.astype(float))
    model = est.fit(train)
    assert np.allclose(model.stages[-1].value("coefficients"), meta, atol=1e-5)
    base = np.column_stack([sig(newton(x[:, cols[b]], y.astype(float), ridge[b]), new[:, cols[b]]) for b in RIDGES])
    scored = model.transform(unseen).orderBy("CustomerID").collect()
    assert np.allclose([r["ensemble"] for r in scored], sig(meta, base), atol=1e-6)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(unseen).orderBy("CustomerID").collect()
    assert again == scored
    parts = {r["model"]: r for r in ML.contributions(model, model.transform(unseen), detailed=True).collect()}
    assert np.isclose(sum(r["weight"] for r in parts.values()), 1, atol=1e-5)
    assert np.isclose(parts["p_one"]["correlation"], np.corrcoef(base[:, 0], sig(meta, base))[0, 1], atol=1e-5)


@pytest.mark.parametrize("method", ["voting", "averaging", "weighted", "blending", "stacking"])
def test_mixed_ensembles_survive_saving(spark, rows, tmp_path, method):
    train, unseen, *_ = rows
    bases = {"ridge": {"kind": ML.RIDGE, "features": FEATURES},
             "forest": {"kind": "random_forest", "features": FEATURES, "numTrees": 5}}
    est = ML.ChurnEnsemble(bases, method, folds=2, weights=[3, 1] if method == "weighted" else None)
    model = est.fit(train)
    out = model.transform(unseen)
    assert set(out.columns) == {*unseen.columns, "p_ridge", "p_forest", "ensemble"}
    got = out.orderBy("CustomerID").collect()
    p = np.array([[r["p_ridge"], r["p_forest"]] for r in got])
    e = np.array([r["ensemble"] for r in got])
    if method == "averaging":
        assert np.allclose(e, p.mean(1))
    if method == "weighted":
        assert np.allclose(e, p @ [0.75, 0.25])
    if method == "voting":
        assert set(e) <= {0.0, 1.0}
    if method == "blending":
        assert np.isclose(sum(model.stages[-1].value("weights")), 1, atol=1e-5)
    assert len(got) == 100 and ((0 <= e) & (e <= 1)).all()
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(unseen).orderBy("CustomerID").collect()
    assert np.allclose([r["ensemble"] for r in again], e)


def test_ensembles_that_cannot_be_fitted(rows):
    train, *_ = rows
    with pytest.raises(ValueError):
        ML.ChurnEnsemble({}, "averaging")
    with pytest.raises(ValueError):
        ML.ChurnEnsemble(RIDGES, "guessing")
    with pytest.raises(ValueError):
        ML.ChurnEnsemble(RIDGES, "averaging").fit(train.withColumn("label", F.lit(1)))


def test_training_run_end_to_end(spark, rows, tmp_path):
    from retentio.operators import metrics as MT
    from retentio.operators.models import ChurnModel
    from retentio.plans import workflows as WF
    train, unseen, _, _, new = rows
    test = unseen.withColumn("label", (F.col("a") > 0).cast("int"))
    out = WF.training_run(train, test, "CustomerID", FEATURES, "random_forest", grid={"numTrees": [3, 5]}, n_iter=None,
                          cv_folds=2, out_path=str(tmp_path / "run"), threshold_metric="f1")
    assert len(out["tuning"]) == 2 and out["cv"].count() == 2 and 0 < out["threshold"] < 1
    again = MT.classification_metrics(out["scored"], threshold=out["threshold"]).first()
    assert again == out["tuned_metrics"].first()
    saved = ChurnModel.load(str(tmp_path / "run" / "model")).predict_proba(test, ["CustomerID"]).orderBy("CustomerID").collect()
    assert [r["prob"] for r in saved] == [r["prob"] for r in out["scored"].orderBy("CustomerID").collect()]
    assert spark.read.parquet(str(tmp_path / "run" / "runs")).count() == 1
