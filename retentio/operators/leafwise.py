"""Leaf-wise gradient boosting for binary labels (survey §2.8, M2, M3, L12, M13).

* Features are cut into at most ``maxBins`` bins at approximate quantiles, once; a row is then one
  byte a feature (0 is a missing value, which goes left) beside label, weight and margin.
* A round of one tree is one job: the rows find their leaf in the tree so far, every task sums
  gradients, hessians and counts per (leaf, feature, bin) in NumPy, and a grouped step adds
  the tasks' histograms of one (leaf, block of features) and returns its best split.  The driver
  sees one row per leaf and block.
* Growth is best first: the leaf with the largest gain is split until ``numLeaves``.  The children of
  every leaf that can still be chosen are evaluated in the same job, so a tree takes about as many
  jobs as it is deep, not one a split, and the tree is that of strict best-first growth.
* Leaf values are Newton steps.  The job that opens a tree also sums the loss of the trees before
  it, on training and validation rows, for the curve and for stopping.  Margins are stored every
  ``KEEP`` trees, trees since then are added up by the tasks.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.session import stored

KEEP = 8
#: rows below which another task is not worth its start
ROWS_A_TASK = 20_000
#: bytes of the histograms that a task holds; more leaves than fit are taken in several jobs
HISTOGRAM_BYTES = 1 << 27
#: features whose histograms are added up together
BLOCK = 8
HIST = "leaf int, block int, g array<double>, h array<double>, n array<double>"
SPLIT = "leaf int, feature int, bin int, gain double, gl double, hl double, nl double, g double, h double, n double"


class Tree:
    """Arrays over nodes; node 0 is the root, ``feature`` -1 marks a leaf, values up to ``bin`` go left."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right = [-1], [0], [0], [0]
        self.value, self.gain, self.cover, self.count, self.depth = [0.0], [0.0], [0.0], [0.0], [0]

    def child(self, depth: int, value: float, cover: float, count: float) -> int:
        for column, v in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.right, 0), (self.value, value),
                          (self.gain, 0.0), (self.cover, cover), (self.count, count), (self.depth, depth)):
            column.append(v)
        return len(self.feature) - 1

    def leaves(self, columns: np.ndarray) -> np.ndarray:
        """Node at which each row ends; ``columns`` holds one line of bytes a feature.  Nodes are taken in order, a
        parent before its children, by steps over whole lines: no row is looked up on its own."""
        kind = np.min_scalar_type(len(self.feature))
        at = np.zeros(columns.shape[1], kind)
        for v, f in enumerate(self.feature):
            if f >= 0:
                here = at == v
                left = here & (columns[f] <= self.bin[v])
                here ^= left
                at += left * kind.type(self.left[v] - v)
                at += here * kind.type(self.right[v] - v)
        return at

    def compact(self) -> "Tree":
        """Without the children that were evaluated and not taken."""
        out, todo = Tree(), [(0, 0)]
        out.value[0], out.cover[0], out.count[0] = self.value[0], self.cover[0], self.count[0]
        while todo:
            old, new = todo.pop(0)
            if self.feature[old] < 0:
                continue
            out.feature[new], out.bin[new], out.gain[new] = self.feature[old], self.bin[old], self.gain[old]
            for side in ("left", "right"):
                c = getattr(self, side)[old]
                getattr(out, side)[new] = out.child(self.depth[c], self.value[c], self.cover[c], self.count[c])
                todo.append((c, getattr(out, side)[new]))
        return out


def find_bins(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """One byte a value: 0 missing, 1 + the number of edges below it."""
    out = np.zeros(values.shape, np.uint8)
    for f, e in enumerate(edges):
        v = values[:, f]
        out[:, f] = np.where(np.isnan(v), 0, 1 + np.searchsorted(e, v, "left"))
    return out


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, ridge: float, least: int) -> tuple[int, float]:
    """(bin, gain) of the best cut of one feature's histogram; gain -inf if no cut leaves ``least`` rows on both sides."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = gl ** 2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain[(nl < least) | (n.sum() - nl < least)] = -np.inf
    at = int(np.argmax(gain))
    return at, float(gain[at])


def _columns(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The bytes of a batch, one line a feature."""
    data = batch.column("bins").cast(pa.binary(width))
    flat = np.frombuffer(data.buffers()[1], np.uint8)[data.offset * width:(data.offset + len(data)) * width]
    return np.ascontiguousarray(flat.reshape(len(data), width).T)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _margin(columns: np.ndarray, margin: np.ndarray, trees: list[Tree]) -> np.ndarray:
    for t in trees:
        margin = margin + np.asarray(t.value)[t.leaves(columns)]
    return margin


def _loss(y, w, margin):
    return float((w * (np.maximum(margin, 0) + np.log1p(np.exp(-np.abs(margin))) - y * margin)).sum())


class _Trainer:
    def __init__(self, rows: DataFrame, width: int, n_bins: int, p: dict):
        self.rows, self.width, self.n_bins, self.p = rows, width, n_bins, p
        self.pending: list[Tree] = []
        self.measured: tuple[float, float | None] | None = None

    def add(self, tree: Tree) -> None:
        self.pending.append(tree)
        self.measured = None
        if len(self.pending) == KEEP:
            self.keep()

    def keep(self) -> None:
        """Add the trees since the last time to the stored margins."""
        width, trees = self.width, list(self.pending)

        def add(batches):
            for b in batches:
                margin = _margin(_columns(b, width), _numbers(b, "margin"), trees)
                yield b.set_column(b.schema.get_field_index("margin"), "margin", pa.array(margin))
        self.rows, self.pending = stored(self.rows.mapInArrow(add, self.rows.schema), "boosting"), []

    def losses(self) -> tuple[float, float | None]:
        """Mean log loss of training and validation rows under the trees so far."""
        if self.measured is None:
            self._splits(Tree(), [0], [0], measure=True)
        return self.measured

    def evaluate(self, tree: Tree, nodes: list[int], features: list[int]) -> dict[int, list]:
        """Best split of every block of features for each node of ``nodes``, from one job (more only if histograms would not fit)."""
        size = self.width * self.n_bins * 24
        step = max(1, HISTOGRAM_BYTES // size)
        found: dict[int, list] = {v: [] for v in nodes}
        for a in range(0, len(nodes), step):
            for r in self._splits(tree, nodes[a:a + step], features, measure=nodes == [0]):
                found[nodes[a + r["leaf"]]].append(r)
        return found

    def _splits(self, tree: Tree, nodes: list[int], features: list[int], measure: bool) -> list:
        """At most one row per node and block of features; ``measure`` also takes the losses (leaves -1 and -2)."""
        width, n_bins, trees, ridge, least = self.width, self.n_bins, list(self.pending), self.p["ridge"], self.p["minChild"]
        slot_of = np.full(len(tree.feature), -1)
        slot_of[nodes] = np.arange(len(nodes))

        def histograms(batches):
            hist, lost = np.zeros((3, len(nodes), len(features), n_bins)), np.zeros((2, 2))
            for b in batches:
                if not b.num_rows:
                    continue
                columns = _columns(b, width)
                margin, y, w, held = _margin(columns, _numbers(b, "margin"), trees), *(_numbers(b, c) for c in ("y", "w", "val"))
                if measure:
                    for val in (0, 1):
                        s = held == bool(val)
                        ys, ws = y[s], w[s]
                        lost[val] += _loss(ys, ws, margin[s]), ws.sum()
                slot = slot_of[tree.leaves(columns)]
                use = np.flatnonzero((slot >= 0) & ~held)
                y, w, key = y[use], w[use], slot[use] * n_bins
                prob = 1 / (1 + np.exp(-margin[use]))
                weights = (w * (prob - y), w * prob * (1 - prob), None)
                for j, f in enumerate(features):
                    cell = key + columns[f][use]
                    for k, v in enumerate(weights):
                        hist[k, :, j, :] += np.bincount(cell, v, len(nodes) * n_bins).reshape(len(nodes), n_bins)
            kinds = pa.int32(), pa.int32(), *[pa.list_(pa.float64())] * 3
            for s in np.flatnonzero(hist[2, :, 0].any(axis=1)):
                parts = [hist[:, s, j:j + BLOCK].reshape(3, -1) for j in range(0, len(features), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(
                    ([s] * len(parts), range(len(parts)), *([q[k] for q in parts] for k in range(3))), kinds)],
                    names=["leaf", "block", *"ghn"])
            for val in (0, 1):
                if lost[val, 1]:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(
                        ([-1 - val], [0], *[[lost[val]]] * 3), kinds)], names=["leaf", "block", *"ghn"])

        def choose(part: pa.Table) -> pa.Table:
            g, h, n = (part.column(c).combine_chunks().flatten().to_numpy().reshape(len(part), -1).sum(axis=0) for c in "ghn")
            leaf, block = part.column("leaf")[0].as_py(), part.column("block")[0].as_py()
            if leaf < 0:
                row = [leaf, 0, 0, g[0] / g[1], *[0.0] * 6]
            else:
                g, h, n = (v.reshape(-1, n_bins) for v in (g, h, n))
                cuts = [best_split(*v, ridge, least) for v in zip(g, h, n)]
                j = max(range(len(cuts)), key=lambda i: (cuts[i][1], -i))
                at, gain = cuts[j]
                row = [leaf, features[BLOCK * block + j], at, gain, g[j, :at + 1].sum(), h[j, :at + 1].sum(), n[j, :at + 1].sum(),
                       g[j].sum(), h[j].sum(), n[j].sum()]
            return pa.table({f.split()[0]: pa.array([v], pa.int32() if f.endswith("int") else pa.float64())
                             for f, v in zip(SPLIT.split(", "), row)})

        rows = self.rows.mapInArrow(histograms, HIST).groupBy("leaf", "block").applyInArrow(choose, SPLIT).collect()
        if measure:
            loss = {r["leaf"]: r["gain"] for r in rows}
            self.measured = loss[-1], loss.get(-2)
        return [r for r in rows if r["leaf"] >= 0]

    def grow(self, features: list[int]) -> Tree | None:
        """The next tree; None if its root has no split with a gain."""
        p, tree, best = self.p, Tree(), {}
        value = lambda g, h: -p["stepSize"] * g / (h + p["ridge"]) if h + p["ridge"] > 0 else 0.0     # noqa: E731

        def learn(nodes):
            for v, rows in self.evaluate(tree, nodes, features).items():
                rows = [r for r in rows if r["gain"] > p["minGain"]]
                best[v] = min(rows, key=lambda r: (-r["gain"], r["feature"], r["bin"])) if rows else None
                if v == 0 and rows:
                    tree.value[0], tree.cover[0], tree.count[0] = value(rows[0]["g"], rows[0]["h"]), rows[0]["h"], rows[0]["n"]

        def split(v):
            r, d = best[v], tree.depth[v] + 1
            tree.feature[v], tree.bin[v], tree.gain[v] = r["feature"], r["bin"], r["gain"]
            tree.left[v] = tree.child(d, value(r["gl"], r["hl"]), r["hl"], r["nl"])
            tree.right[v] = tree.child(d, value(r["g"] - r["gl"], r["h"] - r["hl"]), r["h"] - r["hl"], r["n"] - r["nl"])

        def open_(v):
            """Whether a node may be split at all."""
            return tree.depth[v] < p["maxDepth"] and tree.count[v] >= 2 * p["minChild"]

        learn([0])
        if best[0] is None:
            return None
        leaves, taken = [0], []
        ready: set[int] = set()                      # nodes whose children exist
        while len(leaves) < p["numLeaves"]:
            order = sorted((v for v in leaves if best.get(v)), key=lambda v: (-best[v]["gain"], v))
            if not order:
                break
            room = p["numLeaves"] - len(leaves)
            if order[0] in ready or room == 1:
                v = order[0]
                if v not in ready:
                    split(v)
                leaves.remove(v)
                leaves += [tree.left[v], tree.right[v]]
                taken.append(v)
                continue
            # a leaf that `room` others precede is never reached: its children are not needed
            kids = []
            for v in order[:room]:
                if v not in ready:
                    split(v)
                    ready.add(v)
                    kids += [tree.left[v], tree.right[v]]
            for v in kids:
                best.setdefault(v, None)
            kids = [v for v in kids if open_(v)]
            if kids:
                learn(kids)
        for v in set(range(len(tree.feature))) - set(taken):
            tree.feature[v] = -1
        return tree.compact()


def _typed(name: str, convert):
    return Param(Params._dummy(), name, name, typeConverter=convert)


class LeafwiseModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (a vector) from the vector column ``featuresCol``."""
    featuresCol = _typed("featuresCol", TypeConverters.toString)
    edges = _typed("edges", TypeConverters.toString)
    trees = _typed("trees", TypeConverters.toString)
    init = _typed("init", TypeConverters.toFloat)
    curve = _typed("curve", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", edges=None, trees=None, init=None, curve=None):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**self._input_kwargs)

    def grown(self) -> list[Tree]:
        out = []
        for columns in json.loads(self.getOrDefault("trees")):
            t = Tree()
            t.__dict__.update(columns)
            out.append(t)
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        edges, init, trees = json.loads(self.getOrDefault("edges")), self.getOrDefault("init"), self.grown()

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            bins = find_bins(np.array([[np.nan if v is None else v for v in r] for r in x], float), edges)
            margin = _margin(np.ascontiguousarray(bins.T), np.full(len(x), init), trees)
            prob = 1 / (1 + np.exp(-margin))
            return pd.Series(list(np.stack([1 - prob, prob], axis=1)))

        return df.withColumn("probability", array_to_vector(score(vector_to_array(self.getOrDefault("featuresCol")))))

    def split_rows(self) -> list[tuple]:
        """(tree, node, feature, threshold, gain, cover, count, value) of every node; feature -1 and no threshold for
        leaves; threshold None on an inner node parts missing from present values."""
        edges = json.loads(self.getOrDefault("edges"))
        out = []
        for k, t in enumerate(self.grown()):
            for v, f in enumerate(t.feature):
                cut = edges[f][t.bin[v] - 1] if f >= 0 and 0 < t.bin[v] <= len(edges[f]) else None
                out.append((k, v, f, cut, t.gain[v], t.cover[v], t.count[v], t.value[v]))
        return out

    def importances(self, kind: str = "gain") -> dict[int, float]:
        """Per feature number the splits (weight), or mean gain or mean cover of its splits."""
        sums: dict[int, list[float]] = {}
        for _, _, f, _, gain, cover, _, _ in self.split_rows():
            if f >= 0:
                sums.setdefault(f, []).append({"weight": 1.0, "gain": gain, "cover": cover}[kind])
        return {f: sum(v) if kind == "weight" else sum(v) / len(v) for f, v in sums.items()}

    @property
    def featureImportances(self):
        """Shares of the total gain, as Spark ML's tree models have them."""
        from pyspark.ml.linalg import Vectors
        total: dict[int, float] = {}
        for _, _, f, _, gain, *_ in self.split_rows():
            if f >= 0:
                total[f] = total.get(f, 0.0) + gain
        n = len(json.loads(self.getOrDefault("edges")))
        s = sum(total.values()) or 1.0
        return Vectors.dense([total.get(f, 0.0) / s for f in range(n)])

    def history(self) -> list[tuple]:
        """(trees, training loss, validation loss or None), from no tree on."""
        return [tuple(r) for r in json.loads(self.getOrDefault("curve"))]


class LeafwiseBoosting(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """M2 / M3.  With ``validationIndicatorCol`` the trees after the best validation loss are dropped, and growth
    stops after ``patience`` trees without a better one (0: never)."""
    featuresCol = _typed("featuresCol", TypeConverters.toString)
    labelCol = _typed("labelCol", TypeConverters.toString)
    weightCol = _typed("weightCol", TypeConverters.toString)
    validationIndicatorCol = _typed("validationIndicatorCol", TypeConverters.toString)
    maxIter = _typed("maxIter", TypeConverters.toInt)
    stepSize = _typed("stepSize", TypeConverters.toFloat)
    numLeaves = _typed("numLeaves", TypeConverters.toInt)
    maxDepth = _typed("maxDepth", TypeConverters.toInt)
    minChild = _typed("minChild", TypeConverters.toInt)
    minGain = _typed("minGain", TypeConverters.toFloat)
    ridge = _typed("ridge", TypeConverters.toFloat)
    maxBins = _typed("maxBins", TypeConverters.toInt)
    featureShare = _typed("featureShare", TypeConverters.toFloat)
    patience = _typed("patience", TypeConverters.toInt)
    seed = _typed("seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, validationIndicatorCol=None, maxIter=100,
                 stepSize=0.1, numLeaves=31, maxDepth=5, minChild=20, minGain=0.0, ridge=1.0, maxBins=255, featureShare=0.8,
                 patience=10, seed=42):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", maxIter=100, stepSize=0.1, numLeaves=31, maxDepth=5,
                         minChild=20, minGain=0.0, ridge=1.0, maxBins=255, featureShare=0.8, patience=10, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _column(self, name: str, default):
        return F.col(self.getOrDefault(name)) if self.isDefined(name) else default

    def _fit(self, df: DataFrame) -> LeafwiseModel:
        p = {k.name: self.getOrDefault(k) for k in self.params if self.isDefined(k)}
        if not 2 <= p["maxBins"] <= 255:
            raise ValueError("2 to 255 bins")
        src = stored(df.select(vector_to_array(F.col(p["featuresCol"])).alias("x"), F.col(p["labelCol"]).cast("double").alias("y"),
                               self._column("weightCol", F.lit(1.0)).cast("double").alias("w"),
                               self._column("validationIndicatorCol", F.lit(False)).alias("val")).where("y IS NOT NULL"), "boosting-rows")
        train = src.where(~F.col("val"))
        first = src.first()
        if first is None:
            raise ValueError("no rows to fit on")
        width = len(first["x"])
        probs = [i / p["maxBins"] for i in range(1, p["maxBins"])]
        x = lambda f: F.when(~F.isnan(F.col("x")[f]), F.col("x")[f])                                   # noqa: E731
        cuts = train.agg(*[F.percentile_approx(x(f), probs, 10 * p["maxBins"]).alias(f"c{f}") for f in range(width)],
                         F.sum(F.col("w") * F.col("y")).alias("pos"), F.sum("w").alias("all"),
                         F.count("*").alias("n")).first()
        if not cuts["all"] or not 0 < cuts["pos"] < cuts["all"]:
            raise ValueError("the label takes one value only")
        edges = [sorted(set(cuts[f"c{f}"] or [])) for f in range(width)]
        n_bins = max(len(e) for e in edges) + 2
        init = math.log(cuts["pos"] / (cuts["all"] - cuts["pos"]))

        def pack(batches):
            for b in batches:
                values = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(b), width)
                packed = [r.tobytes() for r in find_bins(values, edges)]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), *(b.column(c) for c in ("y", "w", "val")),
                                                  pa.array(np.full(len(b), init))], names=["bins", "y", "w", "val", "margin"])

        tasks = max(1, min(df.sparkSession.sparkContext.defaultParallelism, cuts["n"] // ROWS_A_TASK))
        # dealt evenly: the stored rows may lie in few files, which would leave tasks without rows in every job
        spread = src.repartition(tasks) if tasks > 1 else src.coalesce(1)
        rows = stored(spread.mapInArrow(pack, "bins binary, y double, w double, val boolean, margin double"), "boosting")
        trainer, trees, rng = _Trainer(rows, width, n_bins, p), [], np.random.default_rng(p["seed"])
        curve = []
        while True:
            use = sorted(rng.choice(width, max(1, round(p["featureShare"] * width)), replace=False).tolist())
            tree = trainer.grow(use) if len(trees) < p["maxIter"] else None
            curve.append((len(trees), *trainer.losses()))                # of the trees before this one
            validated = curve[0][2] is not None
            if validated and p["patience"]:
                best = min(range(len(curve)), key=lambda i: curve[i][2])
                if len(trees) - best >= p["patience"]:
                    break
            if tree is None:
                break
            trees.append(tree)
            trainer.add(tree)
        if validated:
            trees = trees[:min(range(len(curve)), key=lambda i: curve[i][2])]
        plain = lambda t: {k: [v.item() if hasattr(v, "item") else v for v in c] for k, c in t.__dict__.items()}     # noqa: E731
        return LeafwiseModel(featuresCol=p["featuresCol"], edges=json.dumps(edges), trees=json.dumps([plain(t) for t in trees]),
                             init=init, curve=json.dumps(curve))
