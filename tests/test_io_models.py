"""I/O dispatch (S2-S12), streaming projection, SMOTE properties, model registry / persistence."""
import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from retentio.operators import ensemble as EB
from retentio.operators import features as FE
from retentio.operators import models as MD
from retentio.operators import smote as SM
from retentio.sources import io as IO


def _tmp():
    return tempfile.mkdtemp(prefix="retentio-test-")


def test_load_dispatch_and_errors(spark):
    d = _tmp()
    with open(f"{d}/a.json", "w") as f:
        json.dump([{"x": 1, "y": "a"}, {"x": 2, "y": "b"}], f)
    assert IO.load(spark, f"{d}/a.json").count() == 2            # whole-file JSON (S2)
    with pytest.raises(FileNotFoundError):
        IO.load(spark, f"{d}/missing.csv")
    open(f"{d}/b.xlsx", "w").close()
    with pytest.raises(ValueError):
        IO.load(spark, f"{d}/b.xlsx")


def test_save_unknown_suffix_falls_back_to_csv(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert IO.save(df, f"{d}/out.dat") == "csv"
    assert IO.load(spark, f"{d}/out.dat/*.csv").count() == 1


def test_schema_diff_and_threshold_sink(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2)], "x int, z int")
    rows = {tuple(r) for r in IO.schema_diff_frame(spark, a, b).collect()}
    assert rows == {("y", "first"), ("z", "second")}
    d = _tmp()
    IO.write_threshold(spark, f"{d}/thr", "rf", 0.38, {"f1": 0.5})
    r = spark.read.json(f"{d}/thr").first()
    assert r["threshold"] == 0.38 and json.loads(r["metrics"])["f1"] == 0.5


def test_synthetic_is_seeded(spark):
    a = IO.synthetic_churn(spark, 200, seed=42).agg(F.sum("Churn")).first()[0]
    b = IO.synthetic_churn(spark, 200, seed=42).agg(F.sum("Churn")).first()[0]
    assert a == b and 0 < a < 200


def test_streaming_projection_equals_batch(spark, sf):
    from retentio.sources.mart import mart_table
    from retentio.streaming.features import run_available
    src = mart_table(spark, sf)
    d = _tmp()
    out = run_available(spark, os.path.dirname(src.inputFiles()[0].replace("file:", "")), src.schema,
                        f"{d}/out", f"{d}/ckpt", names=["ChurnRiskScore"])
    batch = src.select("CustomerID", *FE.feature_columns(src, ["ChurnRiskScore"]))
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_smote_counts_and_convexity(spark):
    rows = [(i, 1 if i % 5 == 0 else 0, float(i % 7), float(i % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label int, a double, b double")
    out = SM.smote(df, "id", "label", ["a", "b"], ratio=0.5)
    c = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert c[1] == int(0.5 * 160) and c[0] == 160
    synth = out.where(F.col("id").isNull())
    lo_hi = df.where("label = 1").agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    s = synth.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert lo_hi[0] <= s[0] and s[1] <= lo_hi[1] and lo_hi[2] <= s[2] and s[3] <= lo_hi[3]


def test_model_registry_and_persistence(spark):
    with pytest.raises(ValueError):
        MD.create_model("svm", ["a"])
    rows = [(float(i % 10), float((i * 7) % 13), 1 if i % 10 > 6 else 0) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    m = MD.create_model("logistic_regression", ["a", "b"])
    with pytest.raises(ValueError):
        m.predict_proba(df)
    m.fit(df)
    d = _tmp()
    m.save(f"{d}/model")
    m2 = MD.ChurnModel.load(f"{d}/model")
    p1 = [r[0] for r in m.predict_proba(df).collect()]
    p2 = [r[0] for r in m2.predict_proba(df).collect()]
    assert p1 == p2 and all(0 <= p <= 1 for p in p1)


def test_ensemble_weights_and_range(spark):
    assert EB.normalize_weights(2) == [0.5, 0.5]
    assert EB.normalize_weights(2, [1, 3]) == [0.25, 0.75]
    with pytest.raises(ValueError):
        EB.normalize_weights(0)
    df = spark.createDataFrame([(0.2, 0.9, 0.4), (0.6, 0.1, 0.7)], "p1 double, p2 double, p3 double")
    out = EB.combine(df, ["p1", "p2", "p3"], "averaging").collect()
    for r in out:
        assert min(r.p1, r.p2, r.p3) <= r.ensemble <= max(r.p1, r.p2, r.p3)
    assert len(EB.blend_grid(3)) == 55 and len(EB.blend_grid(2)) == 10


def test_credit_mapping_only_when_all_mapped(spark):
    ok = spark.createDataFrame([("Poor",), ("Excellent",)], "CreditRating string")
    bad = spark.createDataFrame([("Poor",), (None,)], "CreditRating string")
    assert [r[0] for r in FE.credit_score_mapped(ok).select("CreditScore").collect()] == [1, 4]
    assert "CreditScore" not in FE.credit_score_mapped(bad).columns


def test_preprocessor_replays_on_holdout(spark, sf):
    from retentio.plans.workflows import Preprocessor, process_and_save
    from retentio.sources.mart import mart_table
    raw = mart_table(spark, sf, raw=True)
    train, hold = raw.where("CustomerID % 2 = 0"), raw.where("CustomerID % 2 = 1").drop("Churn")
    pre = Preprocessor()
    t = pre.fit_transform(train)
    h = pre.transform(hold)
    assert set(h.columns) <= set(t.columns)
    num = [c for c in pre.roles.numeric if c in h.columns]
    assert h.select([F.count_if(F.col(c).isNull()).alias(c) for c in num]).first().asDict() == {c: 0 for c in num}
    d = _tmp()
    train.write.parquet(f"{d}/train.parquet")
    hold.write.parquet(f"{d}/hold.parquet")
    process_and_save(spark, f"{d}/train.parquet", f"{d}/hold.parquet", f"{d}/out")
    assert spark.read.parquet(f"{d}/out/holdout_processed.parquet").count() == hold.count()


def test_deployment_batch_from_a_saved_model(spark):
    from retentio.operators import models as MD
    from retentio.plans.workflows import deployment_batch
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(120)], "id int, a double, b double, label int")
    model = MD.create_model("random_forest", ["a", "b"], "label").fit(df)
    d = _tmp()
    model.save(f"{d}/model")
    live, loaded = deployment_batch(model, df, "id"), deployment_batch(f"{d}/model", df, "id", out_path=f"{d}/scores")
    assert sorted(map(str, live["predictions"].collect())) == sorted(map(str, spark.read.parquet(f"{d}/scores").collect()))
    assert loaded["importances"][0][0] == "a" and loaded["importances"] == live["importances"]
    assert loaded["report"].count() > 0 and loaded["top_risk"].count() > 0


def test_permutation_variants_of_a_logistic_regression_skip_the_pipeline(spark, monkeypatch):
    df = spark.range(0, 400, 1, 2).selectExpr(
        "id", "if(id % 10 = 0, null, int(id % 2)) AS label", "if(id % 9 = 0, null, double(id * 7 % 5)) AS x",
        "int(id % 2 * 4 + id * 3 % 7) AS y", "id % 4 = 1 AS flag", "2.0D AS same")
    feats = ["x", "y", "flag", "same"]
    m = MD.create_model("logistic_regression", feats, "label", maxIter=5).fit(df.dropna())
    calls = []
    plain = MD.ChurnModel.predict_proba
    monkeypatch.setattr(MD.ChurnModel, "predict_proba", lambda self, *a, **k: calls.append(1) or plain(self, *a, **k))
    got = {r["feature"]: (r[1], r[2]) for r in MD.permutation_importance(m, df, "id", "label", n_repeats=2).collect()}
    assert len(calls) == 1                                        # the base scores; not two times four variants of a row
    monkeypatch.setattr(MD.ChurnModel, "linear_form", lambda self: None)
    want = {r["feature"]: (r[1], r[2]) for r in MD.permutation_importance(m, df, "id", "label", n_repeats=2).collect()}
    assert len(calls) == 3 and sorted(got) == sorted(want) == sorted(feats)
    for f in feats:
        assert got[f] == pytest.approx(want[f], abs=1e-9)
    assert got["same"] == pytest.approx((0.0, 0.0), abs=1e-9) and got["y"][0] > 0.05


def test_linear_counts_of_one_feature(spark):
    pairs = spark.sql("SELECT 0 AS _rep, int(id % 2) AS label, double(id) AS x, double(3 - id) AS _d_x FROM range(4)")
    got = MD._linear_counts(pairs, ["x"], "label", ([1.0], [0.5], [2.0], 0.25)).collect()
    want = {round(1 - 1 / (1 + math.exp(x - 1 + 0.25)), 9): (int(x in (0, 2)), int(x in (1, 3))) for x in range(4)}
    assert {round(r["score"], 9): (r["pos"], r["neg"]) for r in got} == want and {r["_variant"] for r in got} == {0}
