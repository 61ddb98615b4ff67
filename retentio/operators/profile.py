"""Profiling / EDA tables (survey §2.2, P1-P19).

Each operator returns the table behind a report or plot.  Column-wise
statistics are computed for all columns in one aggregate (wide) and then
turned into long form on the one-row result; quantiles come from the
partitioned exact-quantile job; nothing is collected except column-bounded
fitted values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.functions.expr import rnd
from retentio.plans.moments import correlation_pairs
from retentio.plans.ordering import exact_quantiles, k_smallest, sort_bounded


def _wide_to_long(row_df: DataFrame, cols: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One-row frame with ``{stat}__{i}`` columns -> one row per column."""
    structs = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("ordinal"),
                        *[F.col(f"{s}__{i}").alias(s) for s in stats]) for i, c in enumerate(cols)]
    return row_df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# P1
def missing_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """column, missing_count, missing_pct (of all rows), largest first."""
    cols = list(cols or df.columns)
    aggs = [F.count_if(F.col(c).isNull()).alias(f"missing_count__{i}") for i, c in enumerate(cols)]
    row = df.agg(F.count("*").alias("n"), *aggs)
    long = _wide_to_long(row.select("*", *[F.col("n").alias(f"n__{i}") for i in range(len(cols))]),
                         cols, ["missing_count", "n"])
    return sort_bounded(long.select("column", "missing_count",
                                    rnd(F.try_divide(F.col("missing_count") * 100.0, F.col("n"))).alias("missing_pct")),
                        F.desc("missing_pct"), "column")


# P2
def nullity_correlation(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Correlation of is-null indicators; columns never or always null are left out."""
    cols = list(cols or df.columns)
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    keep = [c for c in cols if 0 < counts[c] < counts["n"]]
    if len(keep) < 2:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    ind = df.select(*[F.col(c).isNull().cast("double").alias(c) for c in keep])
    return correlation_pairs(ind, keep).select("column_a", "column_b", "corr")


# P3
def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """n_rows and n_duplicate_rows (rows equal to an earlier row; NULLs compare equal)."""
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count("*").alias("cnt"))
    return g.agg(F.sum("cnt").cast("long").alias("n_rows"),
                 F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("long").alias("n_duplicate_rows"))


# P4
def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """n_keys (distinct), n_repeated_keys (keys seen more than once), n_duplicate_rows."""
    g = df.groupBy(key).agg(F.count("*").alias("cnt"))
    return g.agg(F.count("*").alias("n_keys"),
                 F.count_if(F.col("cnt") > 1).alias("n_repeated_keys"),
                 F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("long").alias("n_duplicate_rows"))


# P5
def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(list(df.dtypes), "column string, dtype string")


# P19
def columns_by_type(df: DataFrame, kind: str) -> list[str]:
    """``numeric`` / ``string`` / ``boolean`` column names, schema order."""
    pick = {"numeric": T.NumericType, "string": T.StringType, "boolean": T.BooleanType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, pick)]


# P6
def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count mean std min q25 q50 q75 max per column (exact quantiles), sorted by mean."""
    cols = list(cols or columns_by_type(df, "numeric"))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count__{i}"), F.avg(x).alias(f"mean__{i}"),
                 F.stddev_samp(x).alias(f"std__{i}"), F.min(x).alias(f"min__{i}"), F.max(x).alias(f"max__{i}")]
    stats = _wide_to_long(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"))
    out = stats.join(q, "column", "left")
    return sort_bounded(out.select("column", "count", *[rnd(c).alias(c) for c in
                                                        ["mean", "std", "min", "q25", "q50", "q75", "max"]]),
                        F.desc_nulls_last("mean"), "column")


# P7
def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """Top-k values by share of non-null rows, in percent (value_counts(normalize) * 100)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("count"))
    total = df.where(F.col(col).isNotNull()).select(F.count("*")).scalar()
    return (counts.select("value", "count", rnd(F.col("count") * 100.0 / total).alias("pct"))
            .orderBy(F.desc("count"), "value").limit(k))


# P8
def value_counts(df: DataFrame, col: str) -> DataFrame:
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count("*").alias("count")).orderBy(F.desc("count"), "value"))


# P9 / V9
def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width bins between min and max (last bin closed); empty bins included.

    Bin bounds come from scalar subqueries; the grid of ``bins`` rows is the
    only generated input and its size is the parameter.
    """
    x = F.col(col).cast("double")
    data = df.select(x.alias("x"), *([F.col(by)] if by else [])).where(F.col("x").isNotNull())
    mn = data.select(F.min("x")).scalar()
    mx = data.select(F.max("x")).scalar()
    width = mx - mn
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - mn) * bins / width), F.lit(bins - 1))).cast("int")
    keys = [by] if by else []
    counts = data.groupBy(*keys, idx.alias("bin")).agg(F.count("*").alias("count"))
    bins_col = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    if by:
        # one grid per class, generated from the distinct classes (no join)
        grid = data.select(by).distinct().select(by, bins_col)
    else:
        grid = df.sparkSession.range(1).select(bins_col)
    out = grid.join(counts, [*keys, "bin"], "left")
    return out.select(*keys, "bin",
                      rnd(mn + F.col("bin") * width / bins).alias("lo"),
                      rnd(mn + (F.col("bin") + 1) * width / bins).alias("hi"),
                      F.coalesce("count", F.lit(0)).cast("long").alias("count"))


# P10
def box_stats(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """q1, median, q3, whiskers (most extreme data within 1.5 IQR) and outlier count."""
    keys = [by] if by else []
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], by=keys).select(
        *keys, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    x = F.col(col).cast("double")
    data = df.select(*keys, x.alias("x")).where(F.col("x").isNotNull())
    if keys:
        # q holds one row per class: broadcast is bounded by the number of classes
        j = data.join(F.broadcast(q), keys, "inner")
    else:
        r = q.first()
        j = data.select("x", *[F.lit(r[c]).cast("double").alias(c) for c in ["q1", "median", "q3"]])
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    agg = j.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(F.col("x") >= lo, F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("x") <= hi, F.col("x"))).alias("whisker_high"),
        F.count_if((F.col("x") < lo) | (F.col("x") > hi)).alias("n_outliers"),
        F.count("*").alias("n"))
    return agg.select(*keys, *[rnd(c).alias(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]],
                      "n_outliers", "n")


# P11 / R11
def target_distribution(df: DataFrame, label: str) -> DataFrame:
    g = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    total = df.select(F.count("*")).scalar()
    return sort_bounded(g.select("label", "count", rnd(F.col("count") * 100.0 / total).alias("pct")), "label")


# P12
def rate_by_category(df: DataFrame, cat: str, label: str, positive="Yes") -> DataFrame:
    """Target rate in percent and size per category, highest rate first."""
    y = (F.col(label) == positive).cast("double") if positive is not None else F.col(label).cast("double")
    return (df.groupBy(F.col(cat).alias("category"))
            .agg(rnd(F.avg(y) * 100).alias("rate_pct"), F.count("*").alias("n"))
            .orderBy(F.desc("rate_pct"), "category"))


# P13
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return correlation_pairs(df, cols).select("column_a", "column_b", "n", "corr")


# P14
def top_target_correlations(df: DataFrame, cols: Sequence[str], label: str, k: int = 10) -> DataFrame:
    """The k highest and k lowest correlations of each feature with the label."""
    pairs = correlation_pairs(df.select(*cols, F.col(label).cast("double").alias("__label")), [*cols, "__label"])
    withy = pairs.where(F.col("column_b") == "__label").select(F.col("column_a").alias("feature"), "corr") \
        .where(F.col("corr").isNotNull())
    # one row per feature: the windows below run over a column-count-sized table
    top = withy.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("corr"), "feature")))
    bottom = withy.withColumn("rank", F.row_number().over(Window.orderBy(F.asc("corr"), "feature")))
    return (top.where(F.col("rank") <= k).withColumn("side", F.lit("top"))
            .unionByName(bottom.where(F.col("rank") <= k).withColumn("side", F.lit("bottom"))))


# P15
def correlated_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.7) -> DataFrame:
    return sort_bounded(correlation_pairs(df, cols).where(F.abs("corr") > threshold)
                        .select("column_a", "column_b", "corr"), F.desc(F.abs("corr")), "column_a", "column_b")


# P16
def iqr_outlier_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: rows outside [q1 - 1.5 IQR, q3 + 1.5 IQR]; percent of all rows."""
    cols = list(cols)
    q = exact_quantiles(df, cols, [0.25, 0.75]).collect()  # one row per column
    bounds = {r["column"]: (r["q0"], r["q1"]) for r in q}
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(cols):
        q1, q3 = bounds.get(c, (None, None))
        if q1 is None:
            aggs.append(F.lit(0).cast("long").alias(f"outliers__{i}"))
            continue
        iqr = q3 - q1
        x = F.col(c).cast("double")
        aggs.append(F.count_if((x < q1 - 1.5 * iqr) | (x > q3 + 1.5 * iqr)).alias(f"outliers__{i}"))
    row = df.agg(*aggs)
    long = _wide_to_long(row.select("*", *[F.col("n").alias(f"n__{i}") for i in range(len(cols))]),
                         cols, ["outliers", "n"])
    return sort_bounded(long.select("column", F.col("outliers").alias("outlier_count"),
                                    rnd(F.try_divide(F.col("outliers") * 100.0, F.col("n"))).alias("outlier_pct")),
                        F.desc("outlier_count"), "column")


# P17
def non_numeric_audit(df: DataFrame, cols: Sequence[str], samples: int = 5) -> DataFrame:
    """Per column: count of non-null values failing a numeric parse, and the first
    ``samples`` distinct failing values in sort order (two-stage top-k, no
    unbounded collect)."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    bad = long.where(F.col("value").isNotNull() & F.col("value").try_cast("double").isNull())
    counts = bad.groupBy("column").agg(F.count("*").alias("non_numeric_count"))
    distinct = bad.select("column", "value").distinct()
    ranked = k_smallest(distinct, ["value"], samples, ["column"], rank_name="rk")
    ex = ranked.groupBy("column").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rk", "value"))), lambda s: s["value"]).alias("examples"))
    return sort_bounded(counts.join(ex, "column"), "column")


# P18
def density(df: DataFrame, col: str, by: str | None = None, grid: int = 100) -> DataFrame:
    """Gaussian KDE on a fixed grid between min and max, Scott bandwidth n^(-1/5) * std.

    Rows are first reduced to distinct (class, value) counts; each distinct
    value then spreads over the ``grid`` points (a per-row sequence, fixed
    fan-out) and a grouped sum adds the kernels.
    """
    keys = [by] if by else []
    x = F.col(col).cast("double")
    data = df.select(*keys, x.alias("x")).where(F.col("x").isNotNull())
    mn = data.select(F.min("x")).scalar()
    mx = data.select(F.max("x")).scalar()
    stats = data.groupBy(*keys).agg(F.count("*").alias("n"), F.stddev_samp("x").alias("sd"))
    counts = data.groupBy(*keys, "x").agg(F.count("*").alias("cnt"))
    if keys:
        # stats has one row per class (bounded by the label cardinality)
        j = counts.join(F.broadcast(stats), keys)
    else:
        r = stats.first()
        j = counts.select("*", F.lit(r["n"]).alias("n"), F.lit(r["sd"]).cast("double").alias("sd"))
    bw = F.col("sd") * F.pow(F.col("n").cast("double"), -0.2)
    g = F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g")
    pts = j.select(*keys, "x", "cnt", "n", bw.alias("bw"), g)
    xg = mn + F.col("g") * (mx - mn) / (grid - 1)
    z = (xg - F.col("x")) / F.col("bw")
    k = F.col("cnt") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))
    return (pts.groupBy(*keys, "g").agg(F.sum(k).alias("d"))
            .select(*keys, F.col("g").alias("grid_idx"), rnd(xg).alias("x"), rnd("d").alias("density")))
