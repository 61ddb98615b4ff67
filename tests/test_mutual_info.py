"""Nearest-neighbour mutual information against brute force over all pairs."""

import math

import numpy as np
import pytest

from retentio.operators import mutual_info as MI
from retentio.operators import select as SE


def psi(n):
    return -0.57721566490153286 + math.fsum(1 / i for i in range(1, n))


def brute(x, y, k=3):
    keep = [v is not None and not math.isnan(v) and c is not None for v, c in zip(x, y)]
    x, y = np.array([v for v, s in zip(x, keep) if s], float), np.array([v for v, s in zip(y, keep) if s])
    sizes = {c: int((y == c).sum()) for c in set(y.tolist())}
    s = np.array([sizes[c] > 1 for c in y.tolist()], bool)
    x, y = x[s], y[s]
    if not len(x):
        return 0.0
    terms = []
    for i in range(len(x)):
        same = np.sort(np.abs(np.delete(x, i)[np.delete(y, i) == y[i]] - x[i]))
        near = min(k, len(same))
        r = same[near - 1]
        if r == 0:
            near, m = int(((x == x[i]) & (y == y[i])).sum()), int((x == x[i]).sum())
        else:
            m = int((np.abs(x - x[i]) < r * (1 - 1e-9)).sum())
        terms.append(psi(near) - psi(len(same) + 1) - psi(m))
    return max(0.0, psi(len(x)) + float(np.mean(terms)))


@pytest.mark.parametrize("block,k", [(8192, 3), (5, 3), (2, 1), (9, 8)])
def test_equals_brute_force(spark, block, k):
    rng = np.random.default_rng(block)
    n = 240
    y = [None if v == 3 else int(v) for v in rng.integers(0, 4, n)]
    y[7] = 9                                                        # a class of one row
    z = np.array([0 if v is None else v for v in y], float)
    cols = {"free": rng.normal(size=n) + z, "noise": rng.normal(size=n), "ties": (rng.integers(0, 4, n) + z).astype(float),
            "tenths": rng.integers(0, 40, n) / 10, "constant": np.full(n, 2.5), "copies": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n) * z),
            "zeros": np.where(rng.random(n) < 0.5, 0.0, -0.0), "gaps": rng.normal(size=n), "none": np.full(n, np.nan)}
    data = {c: [None if c == "gaps" and rng.random() < 0.2 else float(a) for a in v] for c, v in cols.items()}
    df = spark.createDataFrame([(*[data[c][i] for c in cols], y[i]) for i in range(n)],
                               ", ".join(f"{c} double" for c in cols) + ", y int")
    got = {r["feature"]: r["mutual_info"] for r in MI.mutual_info(df, list(cols), "y", k, block).collect()}
    assert set(got) == set(cols)
    for c in cols:
        assert abs(got[c] - brute(data[c], y, k)) < 2e-6, c
    assert got["constant"] == got["none"] == 0


def test_estimates_and_selection(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 1500)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(rng.normal(size=1500), y * 10 + rng.normal(size=1500), y)],
                               "noise double, sure double, y int")
    got = {r["feature"]: r["mutual_info"] for r in MI.mutual_info(df, ["noise", "sure"], "y").collect()}
    assert got["noise"] < 0.05 and abs(got["sure"] - math.log(2)) < 0.01
    best = SE.select_k_best(df, ["noise", "sure"], "y", 1, "mutual_info").where("selected").collect()
    assert [r["feature"] for r in best] == ["sure"]
    with pytest.raises(ValueError):
        SE.select_k_best(df, ["noise"], "y", 1, "guess")
    assert MI.mutual_info(df.limit(0), ["noise"], "y").first()["mutual_info"] == 0
