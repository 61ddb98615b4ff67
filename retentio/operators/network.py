"""Neural networks by data-parallel gradient sums (survey §2.8, M4; §2.11, T3).

A round is one Adam step on all rows: every task runs the network over its Arrow batches and
returns one gradient vector, a grouped step adds the tasks' vectors by chunks, and the driver,
which holds the parameters (thousands of numbers, whatever the table), moves them.  The same
loop trains dense networks (ReLU, dropout) and a recurrent network over windows (tanh units).

Dropout masks follow from (seed, round, task, batch) of the stored rows, so a retried task draws
the same masks and a fit with one seed repeats.  With validation rows the step size is halved
after ``plateau`` rounds without a lower validation loss, the fit ends after ``patience``, and the
best parameters are kept.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from retentio.session import stored

#: numbers of a gradient that one grouped step adds up
CHUNK = 4096
#: rows below which another task is not worth its start
ROWS_A_TASK = 20_000


def _shapes(kind: str, width: int, hidden: list[int], steps: int) -> list[tuple[int, ...]]:
    if kind == "recurrent":
        units = hidden[0]
        return [(width // steps, units), (units, units), (units,), (units, 1), (1,)]
    sizes = [width, *hidden, 1]
    return [s for a, b in zip(sizes, sizes[1:]) for s in ((a, b), (b,))]


def split_params(flat: np.ndarray, shapes) -> list[np.ndarray]:
    out, at = [], 0
    for s in shapes:
        n = int(np.prod(s))
        out.append(flat[at:at + n].reshape(s))
        at += n
    return out


def initial(shapes, seed: int) -> np.ndarray:
    """Glorot-uniform matrices, zero biases."""
    rng = np.random.default_rng(seed)
    return np.concatenate([np.zeros(s) if len(s) == 1 else
                           rng.uniform(-1, 1, s).ravel() * np.sqrt(6 / sum(s)) for s in shapes])


def _outer_loss(z, y, w):
    """(sum of weighted log loss, its derivative by the logit)"""
    loss = float((w * (np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z))) - y * z)).sum())
    return loss, w * (1 / (1 + np.exp(-z)) - y)


def dense(p: list[np.ndarray], x, y=None, w=None, masks=None):
    """Logits, or with ``y`` (loss, gradients).  ``masks`` scale the hidden layers' outputs."""
    layers = list(zip(p[::2], p[1::2]))
    outs, a = [x], x
    for k, (m, b) in enumerate(layers):
        a = a @ m + b
        if k < len(layers) - 1:
            a = np.maximum(a, 0)
            if masks is not None:
                a = a * masks[k]
            outs.append(a)
    if y is None:
        return a[:, 0]
    loss, d = _outer_loss(a[:, 0], y, w)
    d, grads = d[:, None], []
    for k in range(len(layers) - 1, -1, -1):
        grads = [outs[k].T @ d, d.sum(0), *grads]
        if k:
            d = d @ layers[k][0].T * (outs[k] > 0)
            if masks is not None:
                d = d * masks[k - 1]
    return loss, grads


def recurrent(p: list[np.ndarray], x, y=None, w=None, steps: int = 3):
    """As ``dense``, for windows of ``steps`` inputs that lie one behind the other in a row."""
    wx, wh, b, v, c = p
    seq = x.reshape(len(x), steps, x.shape[1] // steps)
    h = [np.zeros((len(x), len(b)))]
    for t in range(steps):
        h.append(np.tanh(seq[:, t] @ wx + h[-1] @ wh + b))
    z = (h[-1] @ v + c)[:, 0]
    if y is None:
        return z
    loss, d = _outer_loss(z, y, w)
    gv, gc = h[-1].T @ d[:, None], np.array([d.sum()])
    dh, gx, gh, gb = d[:, None] @ v.T, np.zeros_like(wx), np.zeros_like(wh), np.zeros_like(b)
    for t in range(steps, 0, -1):
        da = dh * (1 - h[t] ** 2)
        gx, gh, gb = gx + seq[:, t - 1].T @ da, gh + h[t - 1].T @ da, gb + da.sum(0)
        dh = da @ wh.T
    return loss, [gx, gh, gb, gv, gc]


def _matrix(x: pd.Series, width: int) -> np.ndarray:
    """Rows of numbers; missing values count as 0, the mean of scaled features."""
    return np.nan_to_num(np.array([[np.nan if v is None else v for v in r] for r in x], float).reshape(len(x), width), nan=0.0)


def _arrow_matrix(x: pa.Array, width: int) -> np.ndarray:
    """``_matrix`` of an Arrow column of lists, without a Python object a row."""
    return np.nan_to_num(x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(x), width), nan=0.0)


def _gradient(rows, flat, shapes, p, width: int, number: int):
    """(gradient, training loss, training weight, validation loss, validation weight), summed over the rows."""
    def run(batches):
        params, total, sums = split_params(flat, shapes), np.zeros(len(flat)), np.zeros(4)
        task = TaskContext.get().partitionId()
        for k, b in enumerate(batches):
            x = _arrow_matrix(b.column("x"), width)
            y, w, val = (b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "val"))
            xt, yt, wt = x[~val], y[~val], w[~val]
            if p["kind"] == "recurrent":
                loss, g = recurrent(params, xt, yt, wt, p["steps"])
                held = recurrent(params, x[val], steps=p["steps"])
            else:
                masks = None
                if p["dropout"] > 0:
                    rng = np.random.default_rng((p["seed"], number, task, k))
                    masks = [(rng.random((len(xt), n)) >= p["dropout"]) / (1 - p["dropout"]) for n in p["hidden"]]
                loss, g = dense(params, xt, yt, wt, masks)
                held = dense(params, x[val])
            total += np.concatenate([v.ravel() for v in g])
            sums += loss, wt.sum(), _outer_loss(held, y[val], w[val])[0], w[val].sum()
        vector = np.concatenate([sums, total])
        at = range(0, len(vector), CHUNK)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([vector[a:a + CHUNK] for a in at], pa.list_(pa.float64()))],
                                         names=["chunk", "v"])

    def add(part: pa.Table) -> pa.Table:
        v = part.column("v").combine_chunks().flatten().to_numpy().reshape(len(part), -1).sum(axis=0)
        return pa.table({"chunk": part.column("chunk").slice(0, 1), "v": pa.array([v.tolist()], pa.list_(pa.float64()))})

    kind = "chunk int, v array<double>"
    parts = rows.mapInArrow(run, kind).groupBy("chunk").applyInArrow(add, kind).collect()          # one row a chunk
    vector = np.concatenate([r["v"] for r in sorted(parts, key=lambda r: r["chunk"])])
    return vector[4:], *vector[:4]


def _typed(name: str, convert):
    return Param(Params._dummy(), name, name, typeConverter=convert)


class NetworkModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (a vector) from the vector column ``featuresCol``."""
    featuresCol = _typed("featuresCol", TypeConverters.toString)
    kind = _typed("kind", TypeConverters.toString)
    hidden = _typed("hidden", TypeConverters.toListInt)
    steps = _typed("steps", TypeConverters.toInt)
    width = _typed("width", TypeConverters.toInt)
    parameters = _typed("parameters", TypeConverters.toListFloat)
    curve = _typed("curve", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", kind="dense", hidden=None, steps=1, width=None, parameters=None, curve=None):
        super().__init__()
        self._setDefault(featuresCol="features", kind="dense", steps=1)
        self._set(**self._input_kwargs)

    def _transform(self, df):
        kind, width, steps = (self.getOrDefault(k) for k in ("kind", "width", "steps"))
        shapes = _shapes(kind, width, self.getOrDefault("hidden"), steps)
        params = split_params(np.array(self.getOrDefault("parameters")), shapes)

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            m = _matrix(x, width)
            prob = 1 / (1 + np.exp(-(recurrent(params, m, steps=steps) if kind == "recurrent" else dense(params, m))))
            return pd.Series(list(np.stack([1 - prob, prob], axis=1)))

        return df.withColumn("probability", array_to_vector(score(vector_to_array(self.getOrDefault("featuresCol")))))

    def history(self) -> list[tuple]:
        """(round, training loss, validation loss or None)."""
        return [tuple(r) for r in json.loads(self.getOrDefault("curve"))]


class NetworkClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """``kind`` is dense (``hidden`` layers of ReLU units with dropout) or recurrent (``hidden[0]`` tanh units over
    ``steps`` inputs).  ``weightCol`` holds class weights."""
    featuresCol = _typed("featuresCol", TypeConverters.toString)
    labelCol = _typed("labelCol", TypeConverters.toString)
    weightCol = _typed("weightCol", TypeConverters.toString)
    validationIndicatorCol = _typed("validationIndicatorCol", TypeConverters.toString)
    kind = _typed("kind", TypeConverters.toString)
    hidden = _typed("hidden", TypeConverters.toListInt)
    steps = _typed("steps", TypeConverters.toInt)
    dropout = _typed("dropout", TypeConverters.toFloat)
    stepSize = _typed("stepSize", TypeConverters.toFloat)
    maxIter = _typed("maxIter", TypeConverters.toInt)
    patience = _typed("patience", TypeConverters.toInt)
    plateau = _typed("plateau", TypeConverters.toInt)
    seed = _typed("seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, validationIndicatorCol=None, kind="dense",
                 hidden=None, steps=1, dropout=0.3, stepSize=0.01, maxIter=100, patience=10, plateau=5, seed=42):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", kind="dense", hidden=[64, 32, 16], steps=1, dropout=0.3,
                         stepSize=0.01, maxIter=100, patience=10, plateau=5, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df) -> NetworkModel:
        p = {k.name: self.getOrDefault(k) for k in self.params if self.isDefined(k)}
        if p["kind"] not in ("dense", "recurrent"):
            raise ValueError(f"unknown kind of network: {p['kind']}")
        column = lambda name, default: F.col(p[name]) if name in p else default                       # noqa: E731
        rows = stored(df.select(vector_to_array(F.col(p["featuresCol"])).alias("x"), F.col(p["labelCol"]).cast("double").alias("y"),
                                column("weightCol", F.lit(1.0)).cast("double").alias("w"),
                                column("validationIndicatorCol", F.lit(False)).alias("val")).where("y IS NOT NULL"), "network")
        first = rows.first()
        if first is None:
            raise ValueError("no rows to fit on")
        n, width = rows.count(), len(first["x"])
        if p["kind"] == "recurrent" and width % p["steps"]:
            raise ValueError("the features do not divide into the steps")
        rows = rows.coalesce(max(1, min(df.sparkSession.sparkContext.defaultParallelism, n // ROWS_A_TASK)))
        shapes = _shapes(p["kind"], width, p["hidden"], p["steps"])
        flat, rate = initial(shapes, p["seed"]), p["stepSize"]
        m, v = np.zeros_like(flat), np.zeros_like(flat)
        best, best_loss, best_at, curve = flat, np.inf, 0, []
        for k in range(p["maxIter"] + 1):
            g, loss, weight, held, held_weight = _gradient(rows, flat, shapes, p, width, k)
            curve.append((k, loss / weight, held / held_weight if held_weight else None))
            if held_weight and held / held_weight < best_loss:
                best, best_loss, best_at = flat, held / held_weight, k
            if held_weight and k - best_at >= p["patience"]:
                break
            if held_weight and k > best_at and (k - best_at) % p["plateau"] == 0:
                rate = max(rate / 2, 1e-6)
            if k == p["maxIter"]:
                break
            g = g / weight
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            flat = flat - rate * (m / (1 - 0.9 ** (k + 1))) / (np.sqrt(v / (1 - 0.999 ** (k + 1))) + 1e-7)
        return NetworkModel(featuresCol=p["featuresCol"], kind=p["kind"], hidden=p["hidden"], steps=p["steps"], width=width,
                            parameters=(best if np.isfinite(best_loss) else flat).tolist(), curve=json.dumps(curve))
