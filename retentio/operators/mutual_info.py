"""Nearest-neighbour mutual information between a feature and a class (survey §2.6, L4).

The estimate is psi(N) + mean(psi(k) - psi(N_class) - psi(m)): the radius of a row reaches to its
k-th neighbour of the same class, m counts the rows of any class nearer than that, with the
row itself.  Where k or more copies share the row's value the radius is 0; then k and m are the copies
in its class and in all classes (which makes the estimate that of a table of counts).

All features are one frame of (feature, class, value, copies), reduced before anything is
shuffled.  Radii come from blocks of consecutive values of a feature and class, each with k values of
its neighbours as a halo; the values get their places from slice-wise running sums, so no
feature and no class meets in one task.  m is the difference of two ranks among all classes: the radius'
ends are sorted in between the values and counted by running sums as well.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.functions.expr import rnd
from retentio.plans.ordering import row_index, running_sum
from retentio.session import stored

#: values of a block
BLOCK = 8192
#: share by which a radius is drawn in, so that the neighbour at its end is outside whatever the rounding
INSIDE = 1 - 1e-9


def digamma(n: Column) -> Column:
    """psi of positive whole numbers: six steps of its recurrence, then the asymptotic series."""
    y = n + 6.0
    tail = F.ln(y) - 1 / (2 * y) - 1 / (12 * y ** 2) + 1 / (120 * y ** 4) - 1 / (252 * y ** 6)
    return tail - sum((1 / (n + float(i)) for i in range(1, 6)), 1 / n)


def _radii(k: int):
    """Radius of each value of a block; rows with ``own`` false are the halo."""
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("value")
        value, copies = block.column("value").to_numpy(), block.column("copies").to_numpy()
        near = min(k, block.column("n_class")[0].as_py() - 1)
        shown = np.minimum(copies, near + 1)                      # more copies change no radius
        line = np.repeat(value, shown)
        at = np.cumsum(shown) - shown
        radius = np.full(len(value), np.inf)
        for j in range(near + 1):                                 # runs of near + 1 values around the first copy
            lo, hi = at - j, at - j + near
            ok = (lo >= 0) & (hi < len(line))
            ends = np.maximum(value[ok] - line[lo[ok]], line[hi[ok]] - value[ok])
            radius[ok] = np.minimum(radius[ok], ends)
        out = block.select(["feature", "label", "value", "copies", "n_class"]).append_column("radius", pa.array(radius))
        return out.filter(block.column("own"))

    return run


def mutual_info(df: DataFrame, cols: Sequence[str], label: str, k: int = 3, block: int = BLOCK) -> DataFrame:
    """(feature, mutual_info) in nats, at least 0.  NULL and NaN values and NULL labels are left out, as are
    classes with one row of a feature; a feature without rows, or constant, gives 0."""
    cols = list(cols)
    if k < 1 or block <= k:
        raise ValueError("k is at least 1 and smaller than a block")
    long = (df.where(F.col(label).isNotNull())
            .select(F.col(label).alias("label"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
            .select("label", F.posexplode(F.array(*[f"c{i}" for i in range(len(cols))])).alias("feature", "value"))
            .where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("value", F.col("value") + 0.0))
    values = stored(long.groupBy("feature", "label", "value").agg(F.count("*").alias("copies")), "mi-values")
    classes = values.groupBy("feature", "label").agg(F.sum("copies").alias("n_class")).where("n_class > 1")
    values = values.join(classes, ["feature", "label"])            # classes: one row per feature and class
    placed = row_index(values, ["value"], ["feature", "label"], name="at")
    mine, inside = F.floor((F.col("at") - 1) / block), F.pmod(F.col("at") - 1, F.lit(block))
    spread = F.filter(F.array(F.struct(mine.alias("block"), F.lit(True).alias("own")),
                              F.when((inside < k) & (mine > 0), F.struct((mine - 1).alias("block"), F.lit(False).alias("own"))),
                              F.when(inside >= block - k, F.struct((mine + 1).alias("block"), F.lit(False).alias("own")))),
                      lambda s: s.isNotNull())
    blocks = placed.select("feature", "label", "value", "copies", "n_class", F.explode(spread).alias("s")) \
        .select("feature", "label", "value", "copies", "n_class", "s.block", "s.own")
    label_type = df.schema[label].dataType.simpleString()
    schema = f"feature int, label {label_type}, value double, copies long, n_class long, radius double"
    # a halo alone is a block behind the last one: it has no rows of its own
    radii = stored(blocks.groupBy("feature", "label", "block").applyInArrow(_radii(k), schema), "mi-radii")
    # ends of the radius: below a value's copies (0), the copies (1), above them (2)
    v, r = F.col("value"), F.col("radius") * INSIDE
    tie = F.col("radius") == 0
    ends = F.explode(F.array(
        F.struct(F.when(tie, v).otherwise(v + r).alias("place"), F.when(tie, 2).otherwise(0).alias("tie"), F.lit(1).alias("sign")),
        F.struct(F.when(tie, v).otherwise(v - r).alias("place"), F.when(tie, 0).otherwise(2).alias("tie"), F.lit(-1).alias("sign")))).alias("e")
    queries = radii.select("feature", "label", "value", ends).select("feature", "label", "value", "e.place", "e.tie", "e.sign",
                                                                     F.lit(0).cast("long").alias("copies"))
    points = radii.groupBy("feature", "value").agg(F.sum("copies").alias("copies")).select(
        "feature", F.lit(None).cast(label_type).alias("label"), "value", F.col("value").alias("place"), F.lit(1).alias("tie"),
        F.lit(0).alias("sign"), "copies")
    line = stored(points.unionByName(queries), "mi-line")
    ranks = running_sum(line, ["place", "tie"], ["copies"], ["feature"], prefix="rank_").where("sign <> 0")
    counts = ranks.groupBy("feature", "label", "value").agg(F.sum(F.col("rank_copies") * F.col("sign")).alias("m"))
    n = radii.groupBy("feature").agg(F.sum("copies").alias("n"))
    near = F.when(tie, F.col("copies")).otherwise(F.least(F.lit(k), F.col("n_class") - 1))
    term = digamma(near) - digamma(F.col("n_class")) - digamma(F.col("m"))
    found = (radii.join(counts, ["feature", "label", "value"]).groupBy("feature")
             .agg((F.sum(F.col("copies") * term) / F.sum("copies")).alias("mean")).join(n, "feature")
             .select("feature", F.greatest(digamma(F.col("n")) + F.col("mean"), F.lit(0.0)).alias("mi")))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "feature int, name string")
    return names.join(found, "feature", "left").select(F.col("name").alias("feature"), rnd(F.coalesce("mi", F.lit(0.0))).alias("mutual_info"))
