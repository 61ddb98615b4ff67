"""Fit/replay semantics of cleaning and encoding."""
from retentio.operators import clean as CL
from retentio.operators import encode as EN


def test_median_imputer_replays_train_value(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    hold = spark.createDataFrame([(None,), (5.0,)], "x double")
    imp = CL.fit_median_imputer(train, ["x"])
    assert imp.values["x"] == 2.0
    assert [r[0] for r in imp.transform(hold).collect()] == [2.0, 5.0]


def test_fallback_uses_own_median(spark):
    hold = spark.createDataFrame([(None, 1.0), (3.0, None), (5.0, 3.0)], "x double, y double")
    imp = CL.fit_median_imputer(spark.createDataFrame([(1.0,)], "x double"), ["x"])
    out = imp.transform(hold, fallback=["y"]).collect()
    assert [r["y"] for r in out] == [1.0, 2.0, 3.0]


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert CL.modes(df, ["c"])["c"] == "a"


def test_outlier_clip_keeps_null_and_skips_clean_columns(spark):
    rows = [(float(i), 1.0) for i in range(30)] + [(1000.0, 1.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "x double, c double")
    fit = CL.fit_outlier_clip(df, ["x", "c"])
    assert "c" not in fit.bounds and "x" in fit.bounds
    out = fit.transform(df).collect()
    assert out[-1]["x"] is None and out[-2]["x"] == fit.bounds["x"][1]


def test_sequential_removal_differs_from_joint(spark):
    rows = [(float(i % 5), float(i % 7)) for i in range(40)] + [(100.0, 3.0), (2.0, 90.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    seq = CL.remove_outliers(df, ["a", "b"], 3.0).count()
    joint = CL.remove_outliers(df, ["a", "b"], 3.0, mode="joint").count()
    assert seq <= 41 and joint <= 41


def test_align_features_missing_extra_reordered(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, extra int, a int")
    out = CL.align_features(df, ["a", "b", "c"])
    assert out.columns == ["a", "b", "c"] and out.first()["c"] == 0


def test_binary_encoder_polarity_and_fallback(spark):
    df = spark.createDataFrame([("Yes", "Known"), ("no", "Unknown"), ("maybe", None)], "p string, h string")
    enc = EN.fit_binary_encoder(df, ["p", "h"])
    out = enc.transform(df).collect()
    assert [r["p"] for r in out] == [1, 0, None]
    assert [r["h"] for r in out] == [0, 1, 2]          # Known < Unknown < nan


def test_label_encoder_unknown_takes_mode_code(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    hold = spark.createDataFrame([("z",), ("b",), ("b",)], "x string")
    enc = EN.fit_label_encoder(train, ["x"])
    assert [r[0] for r in enc.transform(hold).collect()] == [1, 1, 1]


def test_one_hot_unknown_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "x string")
    hold = spark.createDataFrame([("c",), ("a",)], "x string")
    out = EN.fit_one_hot(train, ["x"]).transform(hold)
    assert out.columns == ["x_a", "x_b"]
    assert [tuple(r) for r in out.collect()] == [(0.0, 0.0), (1.0, 0.0)]


def test_scalers_zero_spread(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "c double, x double")
    std = EN.fit_standard_scaler(df, ["c", "x"])
    assert std.scale["c"] == 1.0 and std.scale["x"] == 1.0    # population std of (1, 3) is 1
    mm = EN.fit_minmax_scaler(df, ["c"])
    assert mm.scale["c"] == 1.0
    rb = EN.fit_robust_scaler(df, ["c"])
    assert rb.scale["c"] == 1.0


def test_numeric_mode_ties_compare_numerically(spark):
    df = spark.createDataFrame([(10.0,), (9.0,), (10.0,), (9.0,)], "x double")
    assert CL.modes(df, ["x"])["x"] == 9.0


def test_wide_label_dictionary_and_unknown_binary_value(spark, monkeypatch):
    monkeypatch.setattr(EN, "MAX_LITERAL_CATEGORIES", 5)
    monkeypatch.setattr(EN.distinct_values, "__defaults__", (5,))
    vals = [f"k{i % 40:03d}é" if i % 7 else None for i in range(300)] + ["", "long prefix a", "long prefix b"]
    train = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x string")
    enc = EN.fit_label_encoder(train, ["x"])
    assert list(enc.dictionaries) == ["x"]
    codes = {v: i for i, v in enumerate(sorted({"nan" if v is None else v for v in vals}))}
    got = {r["id"]: r["x"] for r in enc.transform(train).collect()}
    assert got == {i: codes["nan" if v is None else v] for i, v in enumerate(vals)}
    hold = spark.createDataFrame([(1, "unseen"), (2, "k001é"), (3, "k001é")], "id long, x string")
    assert {r["x"] for r in enc.transform(hold).collect()} == {codes["k001é"]}
    known = EN.fit_binary_encoder(spark.createDataFrame([("Known",), ("Unknown",)], "h string"), ["h"])
    out = known.transform(spark.createDataFrame([("Other",), ("Unknown",), ("Unknown",)], "h string"))
    assert [r["h"] for r in out.collect()] == [1, 1, 1]


def test_strict_binary_is_one_bounded_aggregate(spark):
    df = spark.createDataFrame([("Yes", str(i), "Yes") for i in range(50)] + [("No", None, None)], "a string, b string, c string")
    assert EN.strict_binary_columns(df, ["a", "b", "c"]) == ["a"]
    assert EN.strict_binary_columns(df.limit(0), ["a"]) == []
