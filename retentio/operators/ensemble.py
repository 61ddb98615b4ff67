"""Probability ensembles over a wide scored table (survey §2.10, B1-B10).

Input: one probability column per model (``models``) and a 0/1 label.
Combination rules are column expressions; blending evaluates its whole
weight grid in one job: rows are first reduced to distinct (label, p...)
tuples, each tuple is expanded over the grid (a fixed fan-out equal to the
grid size, a parameter) and a grouped aggregation scores every weight
vector at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.functions.expr import rnd
from retentio.operators import metrics as MT
from retentio.plans.moments import correlation_pairs
from retentio.plans.ordering import slice_count


def normalize_weights(n_models: int, weights: Sequence[float] | None = None) -> list[float]:
    """B1: default equal weights; otherwise w / sum(w).  No models -> error."""
    if n_models <= 0:
        raise ValueError("an ensemble needs at least one fitted base model")
    if weights is None:
        return [1.0 / n_models] * n_models
    if len(weights) != n_models:
        raise ValueError("one weight per model is required")
    s = float(sum(weights))
    if s <= 0:
        raise ValueError("weights must have a positive sum")
    return [float(w) / s for w in weights]


def _weighted_sum(models: Sequence[str], weights: Sequence[float]) -> Column:
    out = None
    for m, w in zip(models, weights):
        term = F.col(m) * F.lit(float(w))
        out = term if out is None else out + term
    return out


def voting(models: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """B2: weighted share of models voting churn (p >= 0.5); 1.0 if the share >= 0.5."""
    w = normalize_weights(len(models), weights)
    votes = None
    for m, wi in zip(models, w):
        term = F.when(F.col(m) >= 0.5, F.lit(1)).otherwise(F.lit(0)) * F.lit(wi)
        votes = term if votes is None else votes + term
    share = votes / F.lit(sum(w))
    return F.when(share >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0))


def averaging(models: Sequence[str]) -> Column:
    """Mean probability."""
    total = None
    for m in models:
        total = F.col(m) if total is None else total + F.col(m)
    return total / len(models)


def weighted(models: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """Sum of w * p with normalised weights."""
    return _weighted_sum(models, normalize_weights(len(models), weights))


def combine(df: DataFrame, models: Sequence[str], method: str = "averaging",
            weights: Sequence[float] | None = None, name: str = "ensemble") -> DataFrame:
    if method == "voting":
        e = voting(models, weights)
    elif method == "averaging":
        e = averaging(models)
    elif method == "weighted":
        e = weighted(models, weights)
    elif method == "stacking":
        if weights is None or len(weights) != len(models) + 1:
            raise ValueError("stacking needs the meta-model's intercept and one coefficient per model")
        z = F.lit(float(weights[0]))
        for m, b in zip(models, weights[1:]):
            z = z + F.lit(float(b)) * F.col(m)
        e = 1.0 / (1.0 + F.exp(-z))
    else:
        raise ValueError(f"unknown ensemble method: {method}")
    return df.withColumn(name, e)


# ----------------------------------------------------------------- B6 / B8


def blend_grid(n_models: int, steps: int = 10) -> list[tuple[float, ...]]:
    """The reference's weight grid in iteration order (numpy linspace values).

    Fixed rule: 2 models -> (w, 1 - w); 3 models -> (w1, w2, 1 - w1 - w2) for
    w1 + w2 <= 1; the float values equal numpy's linspace(0, 1, steps).
    """
    step = 1.0 / (steps - 1)
    grid = [i * step for i in range(steps - 1)] + [1.0]
    if n_models == 2:
        return [(w1, 1 - w1) for w1 in grid]
    if n_models == 3:
        return [(w1, w2, 1 - w1 - w2) for w1 in grid for w2 in grid if w1 + w2 <= 1]
    raise ValueError("grid blending is defined for 2 or 3 models; use blend_search for more")


def _blend_scores(df: DataFrame, models: Sequence[str], combos: Sequence[Sequence[float]], label: str,
                  metric: str, threshold: float = 0.5) -> DataFrame:
    """Score every weight vector: returns (combo, w0.., score)."""
    return score_tuples(df.groupBy(label, *models).agg(F.count("*").alias("cnt")), models, combos, label, metric, threshold)


def score_tuples(tuples: DataFrame, models: Sequence[str], combos: Sequence[Sequence[float]], label: str,
                 metric: str, threshold: float = 0.5) -> DataFrame:
    """As ``_blend_scores``, from the distinct (label, scores) with their counts ``cnt``."""
    # one weight vector's scores are bounded by the distinct tuples, not by the expanded grid
    parts = slice_count(tuples)
    arr = F.array(*[F.struct(F.lit(i).alias("combo"), *[F.lit(float(w)).alias(f"w{j}") for j, w in enumerate(c)])
                    for i, c in enumerate(combos)])
    ex = tuples.select(label, "cnt", *models, F.explode(arr).alias("_c"))
    blended = None
    for j, m in enumerate(models):
        term = F.col(m) * F.col(f"_c.w{j}")
        blended = term if blended is None else blended + term
    rows = ex.select(label, "cnt", F.col("_c.combo").alias("combo"), blended.alias("prob"))
    y = F.col(label) == 1
    if metric in ("auc", "average_precision"):
        sc = rows.groupBy("combo", F.col("prob").alias("score")).agg(
            F.sum(F.when(y, F.col("cnt")).otherwise(0)).alias("pos"),
            F.sum(F.when(~y, F.col("cnt")).otherwise(0)).alias("neg"))
        if metric == "auc":
            cum = MT.running_sum(sc, ["score"], ["neg"], ["combo"], num_partitions=parts)
            agg = cum.groupBy("combo").agg(
                F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("u"),
                F.sum("pos").alias("p"), F.sum("neg").alias("n"))
            score = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("u") / (F.col("p") * F.col("n")))
        else:
            cum = MT.running_sum(sc, [-F.col("score")], ["pos", "neg"], ["combo"], num_partitions=parts)
            tot = sc.groupBy("combo").agg(F.sum("pos").alias("P"))
            # one row per weight vector: bounded by the grid size
            cum = cum.join(F.broadcast(tot), "combo")
            agg = cum.groupBy("combo").agg(F.sum(F.col("pos") / F.col("P") * F.col("cum_pos")
                                                 / (F.col("cum_pos") + F.col("cum_neg"))).alias("ap"))
            score = F.col("ap")
        scored = agg.select("combo", score.alias("score"))
    else:
        p = F.col("prob") >= threshold
        cm = rows.groupBy("combo").agg(
            F.sum(F.when(y & p, F.col("cnt")).otherwise(0)).alias("tp"),
            F.sum(F.when(~y & p, F.col("cnt")).otherwise(0)).alias("fp"),
            F.sum(F.when(~y & ~p, F.col("cnt")).otherwise(0)).alias("tn"),
            F.sum(F.when(y & ~p, F.col("cnt")).otherwise(0)).alias("fn"))
        s = MT._scores(cm, ["combo"])
        if metric not in ("accuracy", "precision", "recall", "f1"):
            raise ValueError(f"Unsupported metric: {metric}")
        scored = s.select("combo", F.col(metric).alias("score"))
    wcols = [F.element_at(F.array(*[F.lit(float(c[j])) for c in combos]), F.col("combo") + 1).alias(f"w{j}")
             for j in range(len(models))]
    return scored.select("combo", *wcols, "score")


def blend_weights(df: DataFrame, models: Sequence[str], label: str = "label", metric: str = "auc",
                  steps: int = 10) -> DataFrame:
    """Best weights on the grid; the first combination wins ties (strict >)."""
    combos = blend_grid(len(models), steps)
    scored = _blend_scores(df, models, combos, label, metric)
    best = scored.where(F.col("score").isNotNull()).groupBy().agg(
        F.min(F.struct((-F.col("score")).alias("neg"), F.col("combo"))).alias("b"))
    out = scored.join(best.select(F.col("b.combo").alias("combo")), "combo")
    return out.select(*[rnd(f"w{j}").alias(f"w_{m}") for j, m in enumerate(models)], rnd("score").alias("score"))


def blend_search(df: DataFrame, models: Sequence[str], label: str = "label", metric: str = "auc",
                 samples: int = 64, rounds: int = 3, seed: int = 42) -> DataFrame:
    """B7 (re-aimed SLSQP): seeded simplex samples, then coordinate refinement
    around the incumbent; each round scores all candidates in one grouped job."""
    import random
    rng = random.Random(seed)
    k = len(models)

    def simplex():
        x = [rng.expovariate(1.0) for _ in range(k)]
        s = sum(x)
        return tuple(v / s for v in x)
    cands = [tuple([1.0 / k] * k)] + [simplex() for _ in range(samples)]
    best_w, best_s = None, -1.0
    step = 0.2
    for _ in range(rounds):
        res = _blend_scores(df, models, cands, label, metric).collect()   # one row per candidate
        for r in sorted(res, key=lambda r: r["combo"]):
            if r["score"] is not None and r["score"] > best_s:
                best_s, best_w = r["score"], cands[r["combo"]]
        cands = []
        for i in range(k):
            for d in (-step, step):
                w = list(best_w)
                w[i] = max(0.0, w[i] + d)
                s = sum(w)
                if s > 0:
                    cands.append(tuple(v / s for v in w))
        step /= 2
    return df.sparkSession.createDataFrame([(*[float(w) for w in best_w], float(best_s))],
                                           ", ".join([f"w_{m} double" for m in models] + ["score double"]))


def optimal_weights(df: DataFrame, models: Sequence[str], label: str = "label", metric: str = "auc") -> DataFrame:
    """B6 for two or three models, B7 for more; a single model has weight 1."""
    if len(models) == 1:
        return _blend_scores(df, models, [(1.0,)], label, metric).select(F.lit(1.0).alias(f"w_{models[0]}"), rnd("score").alias("score"))
    if len(models) <= 3:
        return blend_weights(df, models, label, metric)
    from retentio.operators.blend_optimiser import blend_optimise
    return blend_optimise(df, models, label, metric)


# ----------------------------------------------------------------- B9 / B10


def contributions(df: DataFrame, models: Sequence[str], method: str = "weighted",
                  weights: Sequence[float] | None = None, detailed: bool = False,
                  meta_coefficients: Sequence[float] | None = None) -> DataFrame:
    """Correlation of each model with the ensemble output, effective weight,
    and (detailed) the unique contribution proxy (its weight, or 1.0 if it is the only model).
    For stacking ``meta_coefficients`` are the meta-model's, intercept first."""
    w = normalize_weights(len(models), weights)
    ens = combine(df, models, method, meta_coefficients if method == "stacking" else weights, name="__ens")
    corr = correlation_pairs(ens.select(*models, "__ens"), [*models, "__ens"]).where(F.col("column_b") == "__ens")
    if method == "stacking":
        s = sum(abs(c) for c in meta_coefficients[1:])
        eff = [abs(c) / s if s else 0.0 for c in meta_coefficients[1:]]
    else:
        eff = w
    wmap = F.create_map(*[x for m, v in zip(models, eff) for x in (F.lit(m), F.lit(float(v)))])
    out = corr.select(F.col("column_a").alias("model"), F.col("corr").alias("correlation"),
                      rnd(wmap[F.col("column_a")]).alias("weight"))
    if detailed:
        uniq = F.lit(1.0) if len(models) == 1 else F.col("weight")
        out = out.withColumn("unique_contribution", uniq)
    return out
