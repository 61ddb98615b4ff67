"""Leaf-wise boosting against a brute-force grower over the same bins."""

import json

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from retentio.operators import leafwise as LW
from retentio.operators.models import ChurnModel, create_model


def data(n=700, seed=4):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), rng.exponential(size=n), np.full(n, 3.0)])
    x[rng.random(n) < 0.1, 2] = np.nan
    z = x[:, 0] - 0.5 * (x[:, 1] > 2) + np.where(np.isnan(x[:, 2]), 1.0, -0.6 * x[:, 2])
    return x, (z + rng.normal(size=n) * 0.7 > 0).astype(float), rng.choice([1.0, 2.0], n)


def frame(spark, x, y, w=None, val=None):
    rows = [(Vectors.dense(v), float(k), float(w[i]) if w is not None else 1.0, bool(val[i]) if val is not None else False)
            for i, (v, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["features", "label", "weight", "held"])


def brute(bins, y, w, margin, p, features):
    """Strict best-first growth: list of (rows, value) of the leaves, and the splits in order."""
    prob = 1 / (1 + np.exp(-margin))
    g, h = w * (prob - y), w * prob * (1 - prob)

    def best(rows):
        found = None
        for f in features:
            for b in range(bins.max() + 1):
                left = rows[bins[rows, f] <= b]
                right = rows[bins[rows, f] > b]
                if len(left) < p["minChild"] or len(right) < p["minChild"]:
                    continue
                part = lambda r: g[r].sum() ** 2 / (h[r].sum() + p["ridge"])             # noqa: E731
                gain = part(left) + part(right) - part(rows)
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, b, left, right)
        return found

    leaves, splits = [(np.arange(len(y)), 0)], []
    cache = {}
    while len(leaves) < p["numLeaves"]:
        scored = []
        for i, (rows, depth) in enumerate(leaves):
            if depth < p["maxDepth"]:
                key = rows.tobytes()
                cache[key] = cache[key] if key in cache else best(rows)
                if cache[key]:
                    scored.append((cache[key][0], i))
        if not scored:
            break
        _, i = max(scored)
        rows, depth = leaves.pop(i)
        gain, f, b, left, right = cache[rows.tobytes()]
        splits.append((f, b, round(gain, 6), round(h[rows].sum(), 6), len(rows)))
        leaves += [(left, depth + 1), (right, depth + 1)]
    return [(r, -p["stepSize"] * g[r].sum() / (h[r].sum() + p["ridge"])) for r, _ in leaves], splits


@pytest.mark.parametrize("leaves,depth", [(31, 5), (6, 20)])
def test_trees_equal_brute_force(spark, leaves, depth):
    x, y, w = data()
    p = {"numLeaves": leaves, "maxDepth": depth, "minChild": 15, "ridge": 1.0, "stepSize": 0.3}
    est = LW.LeafwiseBoosting(weightCol="weight", maxIter=3, maxBins=20, featureShare=1.0, **p)
    model = est.fit(frame(spark, x, y, w).repartition(3))
    bins = LW.find_bins(x, json.loads(model.getOrDefault("edges")))
    margin = np.full(len(y), np.log((w * y).sum() / (w * (1 - y)).sum()))
    curve = [LW._loss(y, w, margin) / w.sum()]
    for k in range(3):
        found, splits = brute(bins, y, w, margin, p, range(4))
        rows = [r for r in model.split_rows() if r[0] == k]
        tree = model.grown()[k]
        got = [(f, tree.bin[v], round(gain, 6), round(cover, 6), int(n)) for _, v, f, _, gain, cover, n, _ in rows if f >= 0]
        assert sorted(got) == sorted(splits)
        for r, value in found:
            margin[r] += value
        curve.append(LW._loss(y, w, margin) / w.sum())
    assert np.allclose([c[1] for c in model.history()], curve)
    out = model.transform(frame(spark, x, y)).select("probability").collect()
    assert np.allclose([r[0][1] for r in out], 1 / (1 + np.exp(-margin)))
    n_splits = sum(1 for r in model.split_rows() if r[2] >= 0)
    assert sum(model.importances("weight").values()) == n_splits and 3 not in model.importances("cover")
    assert np.isclose(model.featureImportances.toArray().sum(), 1)


def test_stored_margins_and_several_jobs_change_nothing(spark, monkeypatch):
    x, y, _ = data(300)
    fit = lambda: LW.LeafwiseBoosting(maxIter=4, maxBins=10, numLeaves=5, minChild=10).fit(frame(spark, x, y))     # noqa: E731
    one = fit()
    monkeypatch.setattr(LW, "KEEP", 2)
    monkeypatch.setattr(LW, "HISTOGRAM_BYTES", 1)
    two = fit()
    shape = lambda m: [(r[0], r[2], r[3], round(r[4], 6), round(r[7], 8)) for r in m.split_rows()]                   # noqa: E731
    assert shape(one) == shape(two)


def test_validation_stops_growth(spark, tmp_path):
    rng = np.random.default_rng(3)
    x, y, _ = data(500)
    y = np.where(rng.random(500) < 0.35, 1 - y, y)
    est = LW.LeafwiseBoosting(validationIndicatorCol="held", maxIter=40, stepSize=0.8, minChild=2, patience=3, maxBins=30)
    model = est.fit(frame(spark, x, y, val=rng.random(500) < 0.3))
    losses = [c[2] for c in model.history()]
    kept = len(model.grown())
    assert kept == int(np.argmin(losses)) and kept + 3 == len(losses) - 1 < 40
    assert all(a > b for a, b in zip([c[1] for c in model.history()], [c[1] for c in model.history()][1:]))
    model.write().overwrite().save(str(tmp_path / "trees"))
    again = LW.LeafwiseModel.load(str(tmp_path / "trees"))
    f = frame(spark, x[:20], y[:20])
    assert again.transform(f).select("probability").collect() == model.transform(f).select("probability").collect()


def test_edges(spark, tmp_path):
    x, y, _ = data(60)
    with pytest.raises(ValueError):
        LW.LeafwiseBoosting().fit(frame(spark, x, np.ones(60)))
    with pytest.raises(ValueError):
        LW.LeafwiseBoosting().fit(frame(spark, x, y).limit(0))
    stump = LW.LeafwiseBoosting(minChild=60).fit(frame(spark, x, y))           # no split is allowed
    assert stump.grown() == [] and len(stump.history()) == 1
    p = stump.transform(frame(spark, x, y)).select("probability").first()[0][1]
    assert np.isclose(p, y.mean())
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(*data(200)[:2]))],
                               "id long, a double, b double, c double, d double, label int")
    model = create_model("lightgbm", ["a", "b", "c", "d"], "label", maxIter=3).fit(df)
    first = model.predict_proba(df, ["id"]).orderBy("id").collect()
    model.save(str(tmp_path / "churn"))
    assert ChurnModel.load(str(tmp_path / "churn")).predict_proba(df, ["id"]).orderBy("id").collect() == first
    assert model.split_counts()["d"] == 0 and model.split_importances("cover")["a"] > 0
    assert np.isclose(sum(v for _, v in model.feature_importances()), 1) and len(model.training_curve()) == 4
    assert model.predict_proba(df.where(F.lit(False))).count() == 0


def test_leaves_equal_a_walk_row_by_row():
    rng = np.random.default_rng(4)
    for splits in (0, 30, 400):                                  # 400: node numbers beyond a byte
        tree = LW.Tree()
        for _ in range(splits):
            v = int(rng.choice([i for i, f in enumerate(tree.feature) if f < 0]))
            tree.feature[v], tree.bin[v] = int(rng.integers(0, 5)), int(rng.integers(0, 20))
            tree.left[v], tree.right[v] = (tree.child(tree.depth[v] + 1, 0.0, 0.0, 0.0) for _ in range(2))
        columns = rng.integers(0, 20, (5, 300)).astype(np.uint8)
        want = []
        for row in columns.T:
            v = 0
            while tree.feature[v] >= 0:
                v = tree.left[v] if row[tree.feature[v]] <= tree.bin[v] else tree.right[v]
            want.append(v)
        assert tree.leaves(columns).tolist() == want


def test_rows_of_one_file_are_dealt_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(LW, "ROWS_A_TASK", 50)
    kept, plain = [], LW.stored
    monkeypatch.setattr(LW, "stored", lambda df, name: kept.append(plain(df, name)) or kept[-1])
    x, y, w = data()
    LW.LeafwiseBoosting(maxIter=1, maxBins=20).fit(frame(spark, x, y).coalesce(1))
    files = {f for f in kept[1].inputFiles()}
    assert len(files) == min(spark.sparkContext.defaultParallelism, len(y) // 50) > 1
    sizes = [r["n"] for r in kept[1].groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == len(files) and max(sizes) < 2 * min(sizes)
