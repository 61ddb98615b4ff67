"""Metrics against brute force on small frames."""
import itertools

import numpy as np

from retentio.operators import metrics as MT


def _brute_auc(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def _frame(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    p = np.round(np.clip(0.3 * y + rng.random(n) * 0.7, 0, 1), 2)   # many ties
    return spark.createDataFrame([(int(i), int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))],
                                 "id long, label int, prob double"), y, p


def test_auc_tie_aware(spark):
    df, y, p = _frame(spark)
    got = MT.roc_auc(df).first()[0]
    assert abs(got - _brute_auc(y, p)) < 1e-6


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, prob double")
    assert MT.roc_auc(df).first()[0] is None


def test_average_precision_brute(spark):
    df, y, p = _frame(spark)
    thr = sorted(set(p), reverse=True)
    P = y.sum()
    ap, prev_r = 0.0, 0.0
    for t in thr:
        pred = p >= t
        tp = (pred & (y == 1)).sum()
        prec = tp / pred.sum()
        r = tp / P
        ap += (r - prev_r) * prec
        prev_r = r
    assert abs(MT.average_precision(df).first()[0] - ap) < 1e-6


def test_threshold_sweep_brute(spark):
    df, y, p = _frame(spark)
    sw = {round(r["threshold"], 6): r for r in MT.threshold_sweep(df).collect()}
    assert len(sw) == 99
    for i in (0, 20, 49, 98):
        t = 0.01 + i * 0.01
        pred = p >= t
        tp = int((pred & (y == 1)).sum())
        assert sw[round(t, 6)]["tp"] == tp


def test_calibration_prob_one_in_last_bin(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.95), (0, 0.0)], "label int, prob double")
    bins = {r["bin"]: r["count"] for r in MT.calibration(df).collect()}
    assert bins == {9: 2, 0: 1}


def test_zero_division_metrics(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, prob double")
    r = MT.classification_metrics(df, threshold=0.5).first()
    assert r["precision"] == 0.0 and r["f1"] == 0.0 and r["recall"] == 0.0
