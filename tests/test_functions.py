"""Null / ANSI rules N1-N9 on hand-made rows."""
from pyspark.sql import functions as F

from retentio.functions.expr import clip_lower, flag, nz, rnd, sign0
from retentio.operators import features as FE


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (5.0,)], "x double")
    out = [r[0] for r in df.select(clip_lower("x", 1)).collect()]
    assert out == [None, 1.0, 5.0]


def test_nz_only_exact_zero(spark):
    df = spark.createDataFrame([(0.0,), (-2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(nz("x")).collect()] == [1.0, -2.0, None]


def test_flag_null_is_zero_and_int(spark):
    df = spark.createDataFrame([(None,), (1.0,), (-1.0,)], "x double")
    out = df.select(flag(F.col("x") > 0).alias("f"))
    assert out.schema["f"].dataType.simpleString() == "int"
    assert [r[0] for r in out.collect()] == [0, 1, 0]


def test_sign0(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (0.0,), (2.0,)], "x double")
    assert [r[0] for r in df.select(sign0("x")).collect()] == [0.0, -1.0, 0.0, 1.0]


def test_rnd_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5e-6,), (-2.5e-6,), (1.23456789,)], "x double")
    assert [r[0] for r in df.select(rnd("x")).collect()] == [3e-6, -3e-6, 1.234568]


def test_tenure_bucket_first_match_and_unknown(spark):
    df = spark.createDataFrame([(3.0,), (4.0,), (24.0,), (25.0,), (None,)], "MonthsInService double")
    out = [r[0] for r in df.select(*FE.feature_columns(df, ["TenureBucket"])).collect()]
    assert out == ["0-3 months", "4-6 months", "1-2 years", "2+ years", "Unknown"]


def test_tenure_cut_variant_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (3.5,), (100.0,)], "MonthsInService double")
    out = [r[0] for r in df.select(*FE.feature_columns(df, ["TenureBucket"], variant="cut")).collect()]
    assert out == [None, "0-3 months", "3-6 months", "2+ years"]


def test_avg_hh_age_ignores_non_positive(spark):
    df = spark.createDataFrame([(30.0, 0.0), (0.0, 0.0), (20.0, 40.0), (None, 50.0)], "AgeHH1 double, AgeHH2 double")
    out = [r[0] for r in df.select(*FE.feature_columns(df, ["AvgHHAge"])).collect()]
    assert out == [30.0, None, 30.0, 50.0]


def test_churn_risk_score_range(spark):
    from retentio.sources.mart import customer_mart
    m = customer_mart(spark, "/root/testdata/sf0.001")
    r = m.select(*FE.feature_columns(m, ["ChurnRiskScore"])).agg(F.min("ChurnRiskScore"), F.max("ChurnRiskScore")).first()
    assert 0 <= r[0] <= r[1] <= 100
