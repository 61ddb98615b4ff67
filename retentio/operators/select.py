"""Feature selection and statistics (survey §2.6, L1-L4, L8-L10).

All per-feature statistics are computed for every feature in one job:
features are unpivoted to (feature, value, label) and aggregated by
(feature, label) or (feature, bin), so the work is a single partial+final
aggregation rather than a loop of per-column passes.  Decile edges come from
the exact-quantile job and are embedded as a literal map feature -> edges
(bounded by 11 x the number of features).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.functions.expr import rnd
from retentio.plans.moments import correlation_pairs
from retentio.plans.ordering import exact_quantiles, k_smallest, sort_bounded

# IV strength bands, right-closed, as labelled by the reference.
IV_BANDS = [(0.02, "Useless"), (0.1, "Weak"), (0.3, "Medium"), (0.5, "Strong")]
IV_TOP_LABEL = "Very Strong"

#: columns of one wide aggregate, few enough for its code to be compiled
WIDE = 12

# Decile probabilities as numpy's linspace(0, 1, 11) produces them.
DECILE_PROBS = [i * 0.1 for i in range(10)] + [1.0]


# ----------------------------------------------------------------- L1


def drop_correlated(df: DataFrame, cols: Sequence[str], threshold: float = 0.85) -> DataFrame:
    """(feature, ordinal, dropped): a feature is dropped when its absolute correlation
    with ANY earlier feature (dropped or not, N14) exceeds ``threshold``."""
    cols = list(cols)
    pairs = correlation_pairs(df, cols)
    hit = pairs.where(F.abs("corr") > threshold).groupBy("column_b").agg(F.lit(True).alias("dropped"))
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "feature string, ordinal int")
    return (names.join(hit, names.feature == hit.column_b, "left")
            .select("feature", "ordinal", F.coalesce("dropped", F.lit(False)).alias("dropped")))


def kept_after_correlation(df: DataFrame, cols: Sequence[str], threshold: float = 0.85) -> list[str]:
    rows = drop_correlated(df, cols, threshold).collect()   # one row per feature
    dropped = {r["feature"] for r in rows if r["dropped"]}
    return [c for c in cols if c not in dropped]


# ----------------------------------------------------------------- L2 / L3


def _long(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    return (df.select(F.col(label).alias("label"), *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(["label"], list(cols), "feature", "value").where(F.col("value").isNotNull()))


def anova_f(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """ANOVA F (sklearn f_classif formula) per feature from wide aggregates per class.
    Values are taken relative to their column's mean, so that sums of squares do not cancel."""
    cols = list(cols)
    g = None
    for at in range(0, len(cols), WIDE):                 # each scan reads its own columns only
        part = [F.col(c).cast("double") for c in cols[at:at + WIDE]]
        mean = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(part)]).first()
        off = [v - F.lit(mean[f"m{i}"]) for i, v in enumerate(part)]
        wide = df.groupBy(F.col(label).alias("label")).agg(*[e for i, d in enumerate(off) for e in (
            F.count(d).alias(f"n{i}"), F.sum(d).alias(f"s{i}"), F.sum(d * d).alias(f"q{i}"))])
        rows = wide.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("s"), F.col(f"q{i}").alias("ss"))
            for i, c in enumerate(cols[at:at + WIDE])])).alias("_f")).select("_f.*").where("n > 0")
        g = rows if g is None else g.unionByName(rows)
    per = g.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("sum_sq_groups"), F.count("*").alias("k"))
    sstot = F.col("ss") - F.col("s") * F.col("s") / F.col("n")
    ssbn = F.col("sum_sq_groups") - F.col("s") * F.col("s") / F.col("n")
    sswn = sstot - ssbn
    msb = ssbn / (F.col("k") - 1)
    msw = sswn / (F.col("n") - F.col("k"))
    f = F.when((F.col("k") > 1) & (F.col("n") > F.col("k")) & (msw > 0), msb / msw)
    return per.select("feature", rnd(f).alias("f_score"))


def indicator_f(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """ANOVA F of every one-hot indicator of ``cols``, without building an indicator: (source, value, n, f_score).

    An indicator is its non-zeros, so a count per (column, value, class) and the class sizes hold all of its
    moments.  ``cols`` may have any number of values; a NULL value is a zero of every indicator, rows of a NULL
    label are left out, and F is NULL where it has no finite value."""
    cols = list(cols)
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols])
    sizes = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count("*").alias("n")).collect()}     # one row per class
    classes, total = sorted(sizes), sum(sizes.values())
    k = len(classes)
    counts = (rows.unpivot(["_y"], cols, "source", "value").where(F.col("value").isNotNull())
              .groupBy("source", "value").agg(F.count("*").alias("n"), *[
                  F.count_if(F.col("_y") == F.lit(y)).alias(f"_n{i}") for i, y in enumerate(classes)]))
    p = F.col("n") / F.lit(float(max(total, 1)))
    between = within = F.lit(0.0)
    for i, y in enumerate(classes):
        share = F.col(f"_n{i}") / F.lit(float(sizes[y]))
        between = between + F.lit(float(sizes[y])) * (share - p) * (share - p)
        within = within + F.lit(float(sizes[y])) * share * (1 - share)
    if k < 2 or total <= k:
        return counts.select("source", "value", "n", F.lit(None).cast("double").alias("f_score"))
    score = F.when(within > 0, (between / F.lit(float(k - 1))) / (within / F.lit(float(total - k))))
    return counts.select("source", "value", "n", rnd(score).alias("f_score"))


def indicator_correlation(df: DataFrame, cols: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Pearson correlation of every one-hot indicator of ``cols`` with every numeric column (NULL counts as 0),
    from sums over the non-zeros: (source, value, feature, corr); NULL for a constant column."""
    cols, numeric = list(cols), list(numeric)
    x = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric}
    mean = df.agg(F.count("*").alias("n"), *[F.avg(x[c]).alias(f"m{j}") for j, c in enumerate(numeric)],
                  *[F.stddev_pop(x[c]).alias(f"s{j}") for j, c in enumerate(numeric)]).first()
    # relative to the means, so that the sums over the non-zeros are the covariances
    rows = df.select(*[F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(cols)],
                     *[(x[c] - F.lit(mean[f"m{j}"])).alias(f"_x{j}") for j, c in enumerate(numeric)])
    source = F.create_map(*[y for i, c in enumerate(cols) for y in (F.lit(f"_v{i}"), F.lit(c))])
    sums = (rows.unpivot([f"_x{j}" for j in range(len(numeric))], [f"_v{i}" for i in range(len(cols))], "_c", "value")
            .where(F.col("value").isNotNull()).groupBy("_c", "value")
            .agg(F.count("*").alias("_n"), *[F.sum(f"_x{j}").alias(f"_s{j}") for j in range(len(numeric))]))
    n = float(max(mean["n"], 1))
    p = F.col("_n") / F.lit(n)

    def corr(j: int) -> Column:
        std = mean[f"s{j}"]
        return F.when((p < 1) & F.lit(bool(std)), F.col(f"_s{j}") / F.lit(n) / (F.lit(std or 1.0) * F.sqrt(p * (1 - p))))

    out = sums.select(source[F.col("_c")].alias("source"), "value", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), rnd(corr(j)).alias("corr")) for j, c in enumerate(numeric)])).alias("_r"))
    return out.select("source", "value", "_r.*")


def select_encoded(df: DataFrame, numeric: Sequence[str], cols: Sequence[str], label: str, k: int = 30,
                   threshold: float = 0.85) -> DataFrame:
    """L1, L2, L7 on the encoded frame: the ``k`` best of the numeric columns and of all one-hot indicators of
    ``cols`` by ANOVA F, as (source, value, f_score, rank); ``value`` is NULL for a numeric column.  An indicator
    that correlates beyond ``threshold`` with a numeric column goes, like any feature after the one it repeats.
    Ties: by source, numeric first, then by value."""
    repeated = indicator_correlation(df, cols, numeric).where(F.abs("corr") > threshold).select("source", "value").distinct()
    indicators = indicator_f(df, cols, label).drop("n").join(repeated, ["source", "value"], "left_anti")
    kept = kept_after_correlation(df.fillna(0.0, list(numeric)), numeric, threshold)
    plain = anova_f(df.where(F.col(label).isNotNull()).fillna(0.0, list(numeric)), kept, label).select(
        F.col("feature").alias("source"), F.lit(None).cast("string").alias("value"), "f_score")
    scored = plain.unionByName(indicators).where(F.col("f_score").isNotNull())
    return k_smallest(scored, [F.desc("f_score"), F.col("source"), F.asc_nulls_first("value")], k, rank_name="rank")


def sqrt_k(n_features: int) -> int:
    """L3: k = sqrt(number of features), at least 1."""
    return max(1, int(math.sqrt(n_features)))


def select_k_best(df: DataFrame, cols: Sequence[str], label: str, k: int = 30, score: str = "f_classif") -> DataFrame:
    """L2 / L4: (feature, score, rank, selected) with the top-k by score (ties by column order); ``score`` is
    f_classif, mutual_info (nearest neighbours) or mutual_info_binned."""
    from retentio.operators.mutual_info import mutual_info
    cols = list(cols)
    k = min(k, len(cols))
    scores = {"f_classif": anova_f, "mutual_info": mutual_info, "mutual_info_binned": mutual_info_binned}
    if score not in scores:
        raise ValueError(f"unknown score: {score}")
    sc = scores[score](df, cols, label).toDF("feature", "score")
    order = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    # one row per feature: a global window over a column-count-sized table
    from pyspark.sql import Window
    w = Window.orderBy(F.desc_nulls_last("score"), order[F.col("feature")])
    ranked = sc.withColumn("rank", F.row_number().over(w))
    return ranked.select("feature", "score", "rank", (F.col("rank") <= k).alias("selected"))


# ----------------------------------------------------------------- L8-L10, L4


def decile_edges(df: DataFrame, cols: Sequence[str]) -> dict[str, list[float]]:
    """``pd.qcut(x, 10, duplicates='drop')`` edges: distinct interpolated deciles."""
    q = exact_quantiles(df, list(cols), DECILE_PROBS).collect()     # one row per feature
    out = {}
    for r in q:
        vals = [r[f"q{i}"] for i in range(len(DECILE_PROBS))]
        if any(v is None for v in vals):
            continue
        out[r["column"]] = sorted(set(vals))
    return out


def _bin_expr(edges: dict[str, list[float]]) -> Column:
    """Right-closed bins; the first bin also holds the lowest edge."""
    m = F.create_map(*[x for f, e in edges.items() for x in (F.lit(f), F.array(*[F.lit(v) for v in e]))])
    e = m[F.col("feature")]
    idx = F.size(F.filter(e, lambda v: v < F.col("value")))
    return F.greatest(idx, F.lit(1)).cast("string")


def binned(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str) -> DataFrame:
    """(feature, bin, label) rows: deciles for numeric features, the value itself for
    categorical ones; NULLs are left out (pandas groupby drops them)."""
    parts = []
    if numeric:
        edges = decile_edges(df, numeric)
        num = [c for c in numeric if c in edges and len(edges[c]) >= 2]
        if num:
            lg = _long(df, num, label)
            parts.append(lg.select("feature", _bin_expr({c: edges[c] for c in num}).alias("bin"), "label"))
    if categorical:
        cat = (df.select(F.col(label).alias("label"), *[F.col(c).cast("string").alias(c) for c in categorical])
               .unpivot(["label"], list(categorical), "feature", "bin").where(F.col("bin").isNotNull()))
        parts.append(cat.select("feature", "bin", "label"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def woe_table(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str) -> DataFrame:
    """Per (feature, bin): count, events, non-events, event/non-event shares, WOE and IV part.

    WOE = ln(event_pct / non_event_pct); a bin without events or without
    non-events has an infinite WOE and contributes +Infinity to IV (N11).
    """
    b = binned(df, numeric, categorical, label)
    g = b.groupBy("feature", "bin").agg(F.count("*").alias("count"),
                                        F.sum(F.col("label").cast("double")).alias("events"))
    g = g.withColumn("non_events", F.col("count") - F.col("events"))
    tot = g.groupBy("feature").agg(F.sum("events").alias("te"), F.sum("non_events").alias("tn"))
    # tot: one row per feature (bounded by the number of features)
    j = g.join(F.broadcast(tot), "feature")
    ep = F.col("events") / F.col("te")
    np_ = F.col("non_events") / F.col("tn")
    inf = F.lit(float("inf"))
    woe = F.when((F.col("events") == 0) & (F.col("non_events") > 0), -inf) \
        .when((F.col("non_events") == 0) & (F.col("events") > 0), inf).otherwise(F.ln(ep / np_))
    part = F.when(F.col("events") == 0, inf).when(F.col("non_events") == 0, inf).otherwise((ep - np_) * F.ln(ep / np_))
    return j.select("feature", "bin", "count", "events", "non_events", ep.alias("event_pct"),
                    np_.alias("non_event_pct"), woe.alias("woe"), part.alias("iv_part"))


def strength(iv: Column) -> Column:
    """Band label of an IV value."""
    out = None
    for hi, lab in IV_BANDS:
        out = F.when(iv <= hi, F.lit(lab)) if out is None else out.when(iv <= hi, F.lit(lab))
    return out.otherwise(F.lit(IV_TOP_LABEL))


def information_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str) -> DataFrame:
    """(feature, iv, strength) for all features from one grouped job, highest first."""
    w = woe_table(df, numeric, categorical, label)
    iv = w.groupBy("feature").agg(F.sum("iv_part").alias("iv"))
    return sort_bounded(iv.select("feature", rnd("iv").alias("iv"), strength(F.col("iv")).alias("strength")),
                        F.desc("iv"), "feature")


def mutual_info_binned(df: DataFrame, numeric: Sequence[str], label: str,
                       categorical: Sequence[str] = ()) -> DataFrame:
    """L4 (re-aimed): mutual information (nats) between the decile bin and the label."""
    b = binned(df, numeric, categorical, label)
    joint = b.groupBy("feature", "bin", "label").agg(F.count("*").alias("nxy"))
    nx = joint.groupBy("feature", "bin").agg(F.sum("nxy").alias("nx"))
    ny = joint.groupBy("feature", "label").agg(F.sum("nxy").alias("ny"))
    n = joint.groupBy("feature").agg(F.sum("nxy").alias("n"))
    j = joint.join(nx, ["feature", "bin"]).join(ny, ["feature", "label"]).join(F.broadcast(n), "feature")
    term = F.col("nxy") / F.col("n") * F.ln(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return j.groupBy("feature").agg(rnd(F.sum(term)).alias("mutual_info"))
