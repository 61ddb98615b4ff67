"""Exact order statistics without funnelling a group into one task.

Spark's window functions put a whole window partition into one task, and the
``percentile`` aggregate merges every distinct value of a group into one
buffer.  For the few-but-huge groups this library works with (a label class,
a feature column) both would serialise 1/2 or 1/60 of the table on one core.
The helpers below keep every step partitioned, with one plan for any size:

*Running sums and ranks.* (1) cut each group into S slices by approximate
quantiles of the first order key (one eager pass with bounded buffers; the
bounds are literals, so every branch of a plan and every recomputation after
an executor loss assigns a row to the same slice); a row finds its slice by
binary search.  (2) Running sums inside each slice.  (3) Slice totals ->
per-group offsets, a table of at most S x G rows (G the number of groups): the
only broadcast, joined null-safe, so a NULL group is a group like any other.
S follows from the estimated volume and is at least ``MIN_SLICES``.

*Quantiles.* (1) one sketch pass brackets every wanted rank per column: the
sketch's rank error is at most n / ACCURACY, the bracket is wider; (2) one
pass counts, batch by batch in NumPy, the rows below each bracket and the
distinct values inside it, and the exact value is picked from that sliver
(about n / 1200 values per wanted rank).  Nothing is sorted as a whole, no row
is unpivoted, and only values inside a bracket are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_SLICES, MAX_SLICES = 4, 1024
SLICE_BYTES = 64 * 1024 * 1024
#: accuracy of the quantile sketch and half-width of a bracket, in shares of n
ACCURACY, BRACKET = 10_000, 4 / 10_000


def estimated_bytes(df: DataFrame) -> int:
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(v) if isinstance(v, int) else int(v.toString())   # py4j may already convert BigInt
    except Exception:  # noqa: BLE001 - estimate unavailable: assume large
        return 1 << 62


def slice_count(df: DataFrame, num_slices: int | None = None) -> int:
    """Slices per group, from the estimated volume of ``df``."""
    if num_slices:
        return int(num_slices)
    return max(MIN_SLICES, min(MAX_SLICES, -(-estimated_bytes(df) // SLICE_BYTES)))


def same_groups(left: DataFrame, right: DataFrame, cols: Sequence[str], renamed: Sequence[str]) -> Column | None:
    """Null-safe equality of the group columns; ``right`` holds them under ``renamed``."""
    on = None
    for c, r in zip(cols, renamed):
        eq = left[c].eqNullSafe(right[r])
        on = eq if on is None else on & eq
    return on


def with_slices(df: DataFrame, key: str | Column, group_cols: Sequence[str] = (),
                num_slices: int | None = None) -> DataFrame:
    """``df`` with ``_slice``, an integer that is monotone in ``key`` within each group
    (a NULL key is in slice 0).

    The bounds are G x (S - 1) numbers, collected once."""
    group_cols = list(group_cols)
    s = slice_count(df, num_slices)
    k = F.col(key) if isinstance(key, str) else key
    if s <= 1:
        return df.withColumn("_slice", F.lit(0))
    probs = [i / s for i in range(1, s)]
    found = df.groupBy(*group_cols).agg(F.percentile_approx(k, probs, max(ACCURACY, 10 * s)).alias("_bounds"))
    names = [f"_g{i}" for i in range(len(group_cols))]
    found = found.select(*[F.col(c).alias(n) for c, n in zip(group_cols, names)], "_bounds")
    rows = found.collect()                                                      # one row per group
    bounds = df.sparkSession.createDataFrame(rows, found.schema)

    def below(lo: int, hi: int) -> Column:
        """Number of bounds smaller than the key, known to be within [lo, hi]."""
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.get("_bounds", F.lit(mid)) < k, below(mid + 1, hi)).otherwise(below(lo, mid))

    small = F.broadcast(bounds)
    joined = (df.join(small, same_groups(df, bounds, group_cols, names), "left") if group_cols
              else df.withColumn("_bounds", F.lit(list(rows[0]["_bounds"] or []) if rows else [])
                                 .cast(found.schema["_bounds"].dataType)))
    return joined.withColumn("_slice", F.when(F.col("_bounds").isNull() | k.isNull(), 0)
                             .otherwise(below(0, s - 1))).drop("_bounds", *names)


def running_sum(df: DataFrame, order_cols: Sequence[str | Column], sum_cols: Sequence[str],
                group_cols: Sequence[str] = (), num_partitions: int | None = None,
                prefix: str = "cum_", with_totals: bool = False) -> DataFrame:
    """Append inclusive running sums ``{prefix}{c}`` ordered by ``order_cols`` within ``group_cols``.

    ``group_cols`` must be low-cardinality (labels, column names); the first
    order column must be numeric / date / timestamp (it defines the slices).
    Ties in ``order_cols`` are summed in an arbitrary but complete order, so
    callers that need a unique order add a unique tiebreaker.  ``with_totals``
    also returns the group total as ``{prefix}total_{c}`` (no extra pass).
    Every input row comes back, rows of a NULL group included.
    """
    group_cols = list(group_cols)
    orders = [F.col(o) if isinstance(o, str) else o for o in order_cols]
    sliced = with_slices(df, orders[0], group_cols, num_partitions)
    w_local = (Window.partitionBy("_slice", *group_cols).orderBy(*orders)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = sliced.select("*", *[F.sum(c).over(w_local).alias(f"_loc_{c}") for c in sum_cols])
    totals = sliced.groupBy("_slice", *group_cols).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    w_off = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*group_cols)
    names = [f"_h{i}" for i in range(len(group_cols))]
    offsets = totals.select(F.col("_slice").alias("_at"), *[F.col(c).alias(n) for c, n in zip(group_cols, names)], *[
        F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_tot_{c}").over(w_all).alias(f"_all_{c}") for c in sum_cols])
    on = local["_slice"] == offsets["_at"]
    groups = same_groups(local, offsets, group_cols, names)
    # offsets holds at most S x G rows (slices x groups): the only broadcast
    out = local.join(F.broadcast(offsets), on if groups is None else on & groups)
    tot = [F.col(f"_all_{c}").alias(f"{prefix}total_{c}") for c in sum_cols] if with_totals else []
    return out.select(*df.columns, *[(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"{prefix}{c}")
                                     for c in sum_cols], *tot)


def row_index(df: DataFrame, order_cols: Sequence[str | Column], group_cols: Sequence[str] = (),
              name: str = "row_idx", num_partitions: int | None = None) -> DataFrame:
    """1-based ``row_number()`` within low-cardinality groups, computed slice-wise.

    Equivalent to ``row_number() over (partition by group order by order_cols)``
    when ``order_cols`` is unique within a group.
    """
    one = df.withColumn("_one", F.lit(1))
    out = running_sum(one, order_cols, ["_one"], group_cols, num_partitions, prefix="_cum")
    return out.withColumnRenamed("_cum_one", name).drop("_one")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles (pandas ``quantile`` / SQL ``quantile_cont``), exact.

    Returns one row per (by..., column) holding a value, with ``n`` and
    ``q0..q{k-1}`` (an all-null column has no row).  Two narrow passes: the
    sketch, and the counts below and inside the brackets (see above).
    """
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    spark = df.sparkSession
    data = df.select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)],
                     *[F.col(c).cast("double").alias(f"_c{j}") for j, c in enumerate(cols)])
    keys = [f"_by{i}" for i in range(len(by))]
    ends = [min(1.0, max(0.0, p + d)) for p in probs for d in (-BRACKET, BRACKET)]
    sketch = data.groupBy(*keys).agg(*[x for j in range(len(cols)) for x in (
        F.percentile_approx(f"_c{j}", ends, ACCURACY).alias(f"_e{j}"), F.count(f"_c{j}").alias(f"_n{j}"))])
    rows = sketch.collect()                       # groups x columns x 2 probs numbers
    brackets = {(g, j): _brackets(r[f"_e{j}"], r[f"_n{j}"], probs) for g, r in enumerate(rows)
                for j in range(len(cols)) if r[f"_n{j}"]}
    groups = spark.createDataFrame([(g, *[r[k] for k in keys]) for g, r in enumerate(rows)],
                                   T.StructType([T.StructField("_g", T.IntegerType()),
                                                 *[sketch.schema[k] for k in keys]]))
    if keys:
        groups = groups.withColumnsRenamed({k: f"_k{k}" for k in keys})
        data = data.join(F.broadcast(groups), same_groups(data, groups, keys, [f"_k{k}" for k in keys]))
    else:
        data = data.withColumn("_g", F.lit(0))
    counts = (data.select("_g", *[f"_c{j}" for j in range(len(cols))])
              .mapInArrow(_bracket_counts(brackets, len(cols)), "_g int, _j int, _i int, _v double, _cnt long")
              .groupBy("_g", "_j", "_i", "_v").agg(F.sum("_cnt").alias("_cnt")))
    # the NULL value holds the count below the bracket and sorts first
    w = Window.partitionBy("_g", "_j", "_i").orderBy(F.asc_nulls_first("_v")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = spark.createDataFrame([(g, j, r[f"_n{j}"], cols[j]) for g, r in enumerate(rows) for j in range(len(cols))],
                                  "_g int, _j int, n long, column string")
    # sizes holds one row per group and column
    ranked = counts.withColumn("_cum", F.sum("_cnt").over(w)).join(F.broadcast(sizes), ["_g", "_j"])
    position = (F.col("n") - 1) * F.element_at(F.array(*map(F.lit, probs)), F.col("_i") + 1)
    first, last = F.col("_cum") - F.col("_cnt"), F.col("_cum") - 1
    pick = lambda rank: F.max(F.when((rank >= first) & (rank <= last), F.col("_v")))
    lo_hi = ranked.groupBy("_g", "column", "_i", "n").agg(pick(F.floor(position)).alias("_lo"), pick(F.ceil(position)).alias("_hi"),
                                                          F.max(position).alias("_p"))
    value = F.col("_lo") + (F.col("_p") - F.floor("_p")) * (F.col("_hi") - F.col("_lo"))
    out = lo_hi.groupBy("_g", "column", "n").agg(*[F.max(F.when(F.col("_i") == i, value)).alias(f"q{i}")
                                                   for i in range(len(probs))])
    if keys:
        out = out.join(F.broadcast(groups), "_g")
    return out.select(*[F.col(f"_k{k}").alias(b) for k, b in zip(keys, by)], "column", "n",
                      *[f"q{i}" for i in range(len(probs))])


def _brackets(ends: Sequence[float], n: int, probs: Sequence[float]) -> list[tuple[float, float]]:
    """Value bounds that hold each wanted rank: open where they reach an end of the order,
    and on both sides where they would be narrower than two ranks."""
    few = n < 2 / BRACKET
    return [(float("-inf") if few or p <= BRACKET else ends[2 * i],
             float("inf") if few or p >= 1 - BRACKET else ends[2 * i + 1]) for i, p in enumerate(probs)]


def _bracket_counts(brackets: dict, n_cols: int):
    """Per batch: how many values lie below each bracket (value NULL), and the distinct
    values inside it with their counts."""
    def count(batches):
        for b in batches:
            group = b.column("_g").to_numpy()
            out = []
            for g in np.unique(group).tolist():
                rows = pa.array(group == g)
                for j in range(n_cols):
                    if (g, j) not in brackets:
                        continue
                    v = b.column(f"_c{j}").filter(rows).drop_null().to_numpy()
                    for i, (lo, hi) in enumerate(brackets[(g, j)]):
                        below = v < lo
                        if below.any():
                            out.append((g, j, i, [None], [int(below.sum())]))
                        value, cnt = np.unique(v[~below & ~(v > hi)], return_counts=True)
                        out.append((g, j, i, value, cnt))
            size = [len(x[3]) for x in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([x[k] for x in out], size), pa.int32()) for k in range(3)]
                + [pa.array([v for x in out for v in (x[3] if isinstance(x[3], list) else x[3].tolist())], pa.float64()),
                   pa.array([c for x in out for c in (x[4] if isinstance(x[4], list) else x[4].tolist())], pa.int64())],
                names=["_g", "_j", "_i", "_v", "_cnt"])

    return count


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Fitted-state form: {column: [q...]} collected from ``exact_quantiles`` (bounded by len(cols))."""
    out = {c: [None] * len(probs) for c in cols}
    for r in exact_quantiles(df, cols, probs).collect():
        out[r["column"]] = [r[f"q{i}"] for i in range(len(probs))]
    return out


def k_smallest(df: DataFrame, order_cols: Sequence[str | Column], k: int, group_cols: Sequence[str] = (),
               rank_name: str = "rk") -> DataFrame:
    """The ``k`` first rows per group in ``order_cols`` order, with their 1-based rank.

    One window: Spark limits every group to its ``k`` first rows before the
    exchange, so at most k x tasks rows of a group meet.  Needs a total order
    (add a unique tiebreaker) for a deterministic result.
    """
    orders = [F.col(o) if isinstance(o, str) else o for o in order_cols]
    w = Window.partitionBy(*group_cols).orderBy(*orders)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)


def sort_bounded(df: DataFrame, *cols) -> DataFrame:
    """Sort a result whose size is bounded by the number of columns / features /
    classes: one small exchange into one partition, no range-sampling job."""
    return df.repartition(1).sortWithinPartitions(*cols)
