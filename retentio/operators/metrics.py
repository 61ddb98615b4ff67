"""Evaluation metrics over a scored table (survey §2.9, V1-V18).

Input: a DataFrame with a 0/1 label and a probability column (and
optionally a ``model`` column for several models at once).

Every curve metric first reduces rows to distinct-score counts (partial
aggregation: the work after that is bounded by the number of distinct
scores, not rows) and then takes running sums with the slice-wise helper in
``retentio.plans.ordering`` - no single-partition window over rows.  The
threshold sweep bins each distinct score by the 99-point grid, so it never
joins rows with thresholds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.functions.expr import rnd
from retentio.plans.ordering import running_sum
from retentio.session import stored

# The sweep grid is numpy's arange(0.01, 1.0, 0.01) (start + i * step)
# and calibration edges are linspace(0, 1, n + 1) (i * step); both kept bit-exact.
SWEEP_THRESHOLDS = [0.01 + i * 0.01 for i in range(99)]


def calibration_edges(n_bins: int) -> list[float]:
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins + 1)]


def _sdiv(a: Column, b: Column) -> Column:
    """zero_division=0 semantics."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def _keys(model: str | None) -> list[str]:
    return [model] if model else []


# ----------------------------------------------------------------- V1, V2, V7


def confusion_counts(df: DataFrame, label: str = "label", prob: str = "prob", threshold: float = 0.5,
                     model: str | None = None) -> DataFrame:
    """V1: tp fp tn fn (pred = prob >= threshold), one row per model."""
    y, p = F.col(label) == 1, F.col(prob) >= threshold
    return df.groupBy(*_keys(model)).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))


def _scores(cm: DataFrame, keys: list[str]) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ["tp", "fp", "tn", "fn"])
    prec, rec = _sdiv(tp, tp + fp), _sdiv(tp, tp + fn)
    return cm.select(*keys, "tp", "fp", "tn", "fn",
                     _sdiv(tp + tn, tp + fp + tn + fn).alias("accuracy"), prec.alias("precision"),
                     rec.alias("recall"), _sdiv(2 * prec * rec, prec + rec).alias("f1"))


def classification_metrics(df: DataFrame, label: str = "label", prob: str = "prob", threshold: float = 0.5,
                           model: str | None = None) -> DataFrame:
    """V2: accuracy, precision, recall, f1 (zero_division -> 0) with the confusion counts."""
    out = _scores(confusion_counts(df, label, prob, threshold, model), _keys(model))
    return out.select(*_keys(model), "tp", "fp", "tn", "fn",
                      *[rnd(c).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


def classification_report(df: DataFrame, label: str = "label", prob: str = "prob",
                          threshold: float = 0.5) -> DataFrame:
    """V7: per class precision/recall/f1/support, then accuracy, macro and weighted averages."""
    cm = confusion_counts(df, label, prob, threshold)
    tp, fp, tn, fn = (F.col(c) for c in ["tp", "fp", "tn", "fn"])
    p1, r1 = _sdiv(tp, tp + fp), _sdiv(tp, tp + fn)
    p0, r0 = _sdiv(tn, tn + fn), _sdiv(tn, tn + fp)
    f1_1, f1_0 = _sdiv(2 * p1 * r1, p1 + r1), _sdiv(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = _sdiv(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("long").alias("support"))
    rows = [row("0", p0, r0, f1_0, s0), row("1", p1, r1, f1_1, s1),
            row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
            row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
            row("weighted avg", _sdiv(p0 * s0 + p1 * s1, n), _sdiv(r0 * s0 + r1 * s1, n),
                _sdiv(f1_0 * s0 + f1_1 * s1, n), n)]
    out = cm.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.select("class", *[rnd(c).alias(c) for c in ["precision", "recall", "f1"]], "support")


# ----------------------------------------------------------------- V3-V6


def score_counts(df: DataFrame, label: str = "label", prob: str = "prob", model: str | None = None) -> DataFrame:
    """Distinct scores with positive / negative counts (the input of every curve)."""
    y = F.col(label) == 1
    return df.where(F.col(prob).isNotNull()).groupBy(*_keys(model), F.col(prob).cast("double").alias("score")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def roc_auc(df: DataFrame, label: str = "label", prob: str = "prob", model: str | None = None) -> DataFrame:
    """V3: tie-aware AUC (Mann-Whitney); NULL when only one class is present."""
    return auc_of_counts(score_counts(df, label, prob, model), _keys(model))


def auc_of_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``roc_auc`` of distinct scores with their ``pos`` and ``neg``, one row per key."""
    sc = stored(counts, "scores")                               # the slicing reads it three times
    cum = running_sum(sc, ["score"], ["neg"], keys)             # negatives at or below each score
    below = F.col("cum_neg") - F.col("neg")
    agg = cum.groupBy(*keys).agg(
        F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(*keys, rnd(F.when((F.col("p") > 0) & (F.col("n") > 0),
                                        F.col("u") / (F.col("p") * F.col("n")))).alias("roc_auc"))


def _with_totals(df, label, prob, model):
    keys = _keys(model)
    sc = stored(score_counts(df, label, prob, model), "scores")     # the slicing reads it three times
    cum = running_sum(sc, [-F.col("score")], ["pos", "neg"], keys, with_totals=True)
    return cum.withColumnsRenamed({"cum_total_pos": "P", "cum_total_neg": "N"}), keys


def average_precision(df: DataFrame, label: str = "label", prob: str = "prob", model: str | None = None) -> DataFrame:
    """V4: sum over distinct thresholds of (R_n - R_{n-1}) * P_n."""
    cum, keys = _with_totals(df, label, prob, model)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    agg = cum.groupBy(*keys).agg(F.sum(F.col("pos") / F.col("P") * prec).alias("ap"), F.max("P").alias("P"))
    return agg.select(*keys, rnd(F.when(F.col("P") > 0, F.col("ap"))).alias("average_precision"))


def roc_curve(df: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """V5: (threshold, fpr, tpr) at every distinct score, plus the origin at +inf.
    Collinear points are kept (sklearn drops them by default)."""
    cum, _ = _with_totals(df, label, prob, None)
    pts = cum.select(F.col("score").alias("threshold"),
                     rnd(_sdiv(F.col("cum_neg"), F.col("N"))).alias("fpr"),
                     rnd(_sdiv(F.col("cum_pos"), F.col("P"))).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                             F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def pr_curve(df: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """V6: (threshold, precision, recall) per distinct score and the prevalence baseline."""
    cum, _ = _with_totals(df, label, prob, None)
    return cum.select(F.col("score").alias("threshold"),
                      rnd(F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                      rnd(_sdiv(F.col("cum_pos"), F.col("P"))).alias("recall"),
                      rnd(_sdiv(F.col("P"), F.col("P") + F.col("N"))).alias("baseline"))


# ----------------------------------------------------------------- V8, V10


def threshold_sweep(df: DataFrame, label: str = "label", prob: str = "prob", model: str | None = None) -> DataFrame:
    """V8 table: accuracy / precision / recall / f1 at the 99 grid thresholds.

    Each distinct score is mapped to k = number of grid thresholds <= score,
    so pred(t_i) = 1 exactly when i <= k; counts per (label, k) are then
    accumulated over at most 100 values of k.
    """
    keys = _keys(model)
    grid = F.array(*[F.lit(t) for t in SWEEP_THRESHOLDS])
    sc = score_counts(df, label, prob, model)
    k = F.size(F.filter(grid, lambda t: t <= F.col("score")))
    by_k = sc.groupBy(*keys, k.alias("k")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # at most 100 rows per model: expand to the grid and count rows with k >= i
    expanded = by_k.select(*keys, "pos", "neg", F.explode(F.sequence(F.lit(1), F.lit(99))).alias("i"),
                           "k").where(F.col("k") >= F.col("i"))
    tp_fp = expanded.groupBy(*keys, "i").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp"))
    totals = by_k.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    grid_rows = totals.select(*keys, "P", "N", F.explode(F.sequence(F.lit(1), F.lit(99))).alias("i"))
    j = grid_rows.join(tp_fp, [*keys, "i"], "left").fillna(0, ["tp", "fp"])
    cm = j.select(*keys, "i", "tp", "fp", (F.col("N") - F.col("fp")).alias("tn"), (F.col("P") - F.col("tp")).alias("fn"))
    s = _scores(cm, [*keys, "i"])
    return s.select(*keys, rnd(F.element_at(grid, F.col("i"))).alias("threshold"), "tp", "fp", "tn", "fn",
                    *[rnd(c).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


def best_threshold(df: DataFrame, metric: str = "f1", label: str = "label", prob: str = "prob",
                   model: str | None = None) -> DataFrame:
    """V8: first (lowest) grid threshold with the maximum metric."""
    if metric not in ("f1", "precision", "recall", "accuracy"):
        raise ValueError(f"Unsupported metric: {metric}")
    keys = _keys(model)
    sw = threshold_sweep(df, label, prob, model)
    best = sw.groupBy(*keys).agg(F.min(F.struct((-F.col(metric)).alias("neg"), F.col("threshold"))).alias("b"))
    return best.select(*keys, F.col("b.threshold").alias("threshold"), (-F.col("b.neg")).alias("score"))


def calibration(df: DataFrame, label: str = "label", prob: str = "prob", n_bins: int = 10,
                model: str | None = None) -> DataFrame:
    """Mean predicted vs observed rate per bin (numpy digitize on linspace edges,
    p = 1 in the last bin); empty bins are absent."""
    keys = _keys(model)
    edges = F.array(*[F.lit(e) for e in calibration_edges(n_bins)])
    b = F.size(F.filter(edges, lambda e: e <= F.col(prob))) - 1
    b = F.when(b < 0, 0).when(b > n_bins - 1, n_bins - 1).otherwise(b)
    return (df.groupBy(*keys, b.alias("bin"))
            .agg(rnd(F.avg(F.col(prob))).alias("prob_pred"), rnd(F.avg(F.col(label).cast("double"))).alias("prob_true"),
                 F.count("*").alias("count")))


# ----------------------------------------------------------------- V12-V17


def long_scores(df: DataFrame, models: Sequence[str], id_col: str = "id", label: str = "label") -> DataFrame:
    """Wide scored table (one column per model) -> (id, label, model, prob)."""
    return df.select(id_col, label, *models).unpivot([id_col, label], list(models), "model", "prob")


def compare_models(df: DataFrame, models: Sequence[str], label: str = "label", threshold: float = 0.5) -> DataFrame:
    """Metric x model table (accuracy, precision, recall, f1, roc_auc)."""
    lg = long_scores(df, models, label=label)
    cls = classification_metrics(lg, label, "prob", threshold, model="model")
    auc = roc_auc(lg, label, "prob", model="model")
    wide = cls.join(auc, "model")
    metrics = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    long = wide.select("model", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                                    for m in metrics])).alias("r")).select("model", "r.*")
    return long.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))


def best_model(df: DataFrame, models: Sequence[str], metric: str = "f1", label: str = "label") -> DataFrame:
    """The model with the highest metric (ties -> first in ``models`` order)."""
    cmp = compare_models(df, models, label).where(F.col("metric") == metric)
    cands = F.array(*[F.struct(F.col(m).alias("v"), F.lit(-i).alias("neg_pos"), F.lit(m).alias("model"))
                      for i, m in enumerate(models)])
    return cmp.select("metric", F.array_max(cands).alias("b")).select(
        "metric", F.col("b.model").alias("best_model"), F.col("b.v").alias("value"))


def improvement_table(df: DataFrame, base: str, new: str, label: str = "label") -> DataFrame:
    """Per metric base, new, absolute and percent improvement."""
    cmp = compare_models(df, [base, new], label)
    return cmp.select("metric", F.col(base).alias("base"), F.col(new).alias("new"),
                      rnd(F.col(new) - F.col(base)).alias("abs_improvement"),
                      rnd(F.when(F.col(base) != 0, (F.col(new) - F.col(base)) / F.col(base) * 100)).alias("pct_improvement"))


# Business-impact defaults of the retention campaign.
AVG_CUSTOMER_VALUE, RETENTION_COST, RETENTION_SUCCESS_RATE = 1000.0, 200.0, 0.3


def business_impact(df: DataFrame, label: str = "label", prob: str = "prob", threshold: float = 0.5,
                    value: float = AVG_CUSTOMER_VALUE, cost: float = RETENTION_COST,
                    rate: float = RETENTION_SUCCESS_RATE, model: str | None = None) -> DataFrame:
    """V15 (V16 with ``model``): campaign value from the confusion counts."""
    keys = _keys(model)
    cm = confusion_counts(df, label, prob, threshold, model)
    tp, fp, tn, fn = (F.col(c) for c in ["tp", "fp", "tn", "fn"])
    retained = tp * rate
    ret_value = retained * value
    total_cost = (tp + fp) * cost
    return cm.select(*keys, (tp + fp + tn + fn).alias("total_customers"), (tp + fn).alias("actual_churners"),
                     (tp + fp).alias("predicted_churners"), "tp", "fp", "tn", "fn",
                     rnd(retained).alias("retained_customers"), rnd(ret_value).alias("retention_value"),
                     rnd(fp * cost).alias("wasted_retention_cost"), rnd(fn * value).alias("missed_churn_cost"),
                     rnd(total_cost).alias("total_retention_cost"), rnd(ret_value - total_cost).alias("net_value"),
                     rnd(F.when(total_cost > 0, (ret_value - total_cost) / total_cost).otherwise(0.0)).alias("roi"))


def top_risk(df: DataFrame, prob: str = "prob", k: int = 20, id_col: str = "id") -> DataFrame:
    """The k highest-probability rows (ties by id); Spark plans a two-phase top-k."""
    return df.orderBy(F.desc(prob), F.asc(id_col)).limit(k)
