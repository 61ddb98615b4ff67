"""Blend weights by constrained ascent on the simplex (survey §2.10, B7).

One job a round: every candidate's blended scores fall into bins, and each (candidate, bin,
class) keeps its row count and the sum of every model's score.  From those few numbers the
driver takes the metric of the smoothed histogram and its gradient in the weights: a row that
moves up by one bin changes the metric by what its class is worth one bin higher.  The next
candidates are Frank-Wolfe, pairwise and projected steps from the incumbent.  The exact metric
of every incumbent is scored at the end, so a returned score is never the smoothed one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.operators.ensemble import score_tuples
from retentio.session import stored

BINS = 512
#: width of the smoothing kernel, in bins, and the step lengths tried from an incumbent
KERNEL, STEPS = 4.0, (1.0, 0.5, 0.2, 0.08, 0.03, 0.01)
THRESHOLD_METRICS = ("accuracy", "precision", "recall", "f1")


def project(v: np.ndarray) -> np.ndarray:
    """The nearest point of the simplex."""
    u = np.sort(v)[::-1]
    excess = (np.cumsum(u) - 1) / np.arange(1, v.size + 1)
    return np.maximum(v - excess[np.flatnonzero(u > excess)[-1]], 0)


def _kernel() -> np.ndarray:
    d = np.subtract.outer(np.arange(BINS), np.arange(BINS)) / KERNEL
    k = np.exp(-0.5 * d * d)
    return k / k.sum(axis=0)                                  # keeps the mass of every bin


def histogram_metric(pos: np.ndarray, neg: np.ndarray, metric: str, threshold: float = 0.5) -> np.ndarray:
    """The metric of binned scores; ``pos`` and ``neg`` may hold several histograms, one a row."""
    p, n = pos.sum(-1), neg.sum(-1)
    if metric == "auc":
        return (pos * (np.cumsum(neg, -1) - neg / 2)).sum(-1) / (p * n)
    if metric == "average_precision":
        above, wrong = (np.cumsum(h[..., ::-1], -1)[..., ::-1] for h in (pos, neg))
        return (pos * above / np.maximum(above + wrong, 1e-12)).sum(-1) / p
    cut = int(round(threshold * BINS))
    tp, fp = pos[..., cut:].sum(-1), neg[..., cut:].sum(-1)
    tiny = 1e-12
    return {"accuracy": (tp + n - fp) / (p + n), "precision": tp / np.maximum(tp + fp, tiny), "recall": tp / p,
            "f1": 2 * tp / np.maximum(p + tp + fp, tiny)}[metric]


def _value_and_gradient(hist: dict, metric: str, threshold: float, kernel: np.ndarray) -> tuple[float, np.ndarray]:
    pos, neg = kernel @ hist["pos"], kernel @ hist["neg"]
    value = float(histogram_metric(pos, neg, metric, threshold))
    total = pos.sum() + neg.sum()
    unit = 1e-4 * total * np.eye(BINS)
    gradient = 0.0
    for worth, sums in (((histogram_metric(pos + unit, neg, metric, threshold) - value), hist["pos_x"]),
                        ((histogram_metric(pos, neg + unit, metric, threshold) - value), hist["neg_x"])):
        slope = np.gradient(kernel.T @ (worth / (1e-4 * total))) * BINS
        gradient = gradient + slope @ sums
    return value, gradient


def _histograms(rows: DataFrame, models: Sequence[str], candidates: Sequence[np.ndarray], label: str) -> list[dict]:
    """Of every candidate: counts a class and bin and sums of the models' scores; BINS x 2 rows a candidate."""
    weights = F.array(*[F.struct(F.lit(i).alias("i"), *[F.lit(float(x)).alias(f"w{j}") for j, x in enumerate(w)])
                        for i, w in enumerate(candidates)])
    ex = rows.select(F.col(label).alias("_y"), "cnt", *models, F.explode(weights).alias("_c"))
    blended = sum(F.col(m) * F.col(f"_c.w{j}") for j, m in enumerate(models))
    bins = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(blended * BINS))).cast("int")
    found = ex.groupBy(F.col("_c.i").alias("i"), bins.alias("bin"), (F.col("_y") == 1).alias("y")).agg(
        F.sum("cnt").alias("n"), *[F.sum(F.col(m) * F.col("cnt")).alias(f"x{j}") for j, m in enumerate(models)]).collect()
    out = [{"pos": np.zeros(BINS), "neg": np.zeros(BINS), "pos_x": np.zeros((BINS, len(models))),
            "neg_x": np.zeros((BINS, len(models)))} for _ in candidates]
    for r in found:
        side = "pos" if r["y"] else "neg"
        out[r["i"]][side][r["bin"]] += r["n"]
        out[r["i"]][f"{side}_x"][r["bin"]] += [r[f"x{j}"] for j in range(len(models))]
    return out


def _steps(w: np.ndarray, g: np.ndarray) -> list[np.ndarray]:
    """Frank-Wolfe, pairwise and projected steps from ``w`` along the gradient ``g``."""
    best = int(np.argmax(g))
    held = np.flatnonzero(w > 0)
    worst = int(held[np.argmin(g[held])])
    vertex = np.eye(w.size)
    along = g - g.mean()
    norm = float(np.linalg.norm(along)) or 1.0
    out = []
    for s in STEPS:
        out += [w + s * (vertex[best] - w), w + min(s, w[worst]) * (vertex[best] - vertex[worst]), project(w + s * along / norm)]
    unique = {tuple(np.round(c, 9)): c for c in out if np.abs(c - w).max() > 1e-9}
    return list(unique.values())


def blend_optimise(df: DataFrame, models: Sequence[str], label: str = "label", metric: str = "auc", rounds: int = 10,
                   threshold: float = 0.5) -> DataFrame:
    """One row of weights (not negative, sum 1) and their exact score, for any number of models.

    ``models`` are probability columns; rows where one of them or the label is NULL are left out.  Without rows
    of both classes the weights are equal, and the score of auc and average_precision is NULL."""
    models = list(models)
    if metric not in ("auc", "average_precision", *THRESHOLD_METRICS):
        raise ValueError(f"Unsupported metric: {metric}")
    rows = stored(df.select(label, *[F.col(m).cast("double").alias(m) for m in models]).dropna()
                  .groupBy(label, *models).agg(F.count("*").alias("cnt")), "blend-rows")
    kernel, k = _kernel(), len(models)
    even = np.full(k, 1.0 / k)
    starts = [even, *np.eye(k)]
    hists = _histograms(rows, models, starts, label)
    visited = [even]
    if hists[0]["pos"].sum() and hists[0]["neg"].sum():
        scored = [_value_and_gradient(h, metric, threshold, kernel) for h in hists]
        at = int(np.argmax([v for v, _ in scored]))
        w, (value, g) = starts[at], scored[at]
        visited = list(starts)
        for _ in range(rounds):
            candidates = _steps(w, g)
            if not candidates:
                break
            scored = [_value_and_gradient(h, metric, threshold, kernel) for h in _histograms(rows, models, candidates, label)]
            at = int(np.argmax([v for v, _ in scored]))
            if scored[at][0] <= value + 1e-9:
                break
            w, (value, g) = candidates[at], scored[at]
            visited.append(w)
    elif metric in ("auc", "average_precision"):
        return df.sparkSession.createDataFrame([(*even.tolist(), None)],
                                               ", ".join([f"`w_{m}` double" for m in models] + ["score double"]))
    exact = score_tuples(rows, models, [tuple(map(float, w)) for w in visited], label, metric, threshold)
    best = exact.groupBy().agg(F.min(F.struct((-F.col("score")).alias("neg"), F.col("combo"),
                                              *[f"w{j}" for j in range(k)])).alias("b"))
    return best.select(*[F.coalesce(f"b.w{j}", F.lit(1.0 / k)).alias(f"w_{m}") for j, m in enumerate(models)],
                       (-F.col("b.neg")).alias("score"))
