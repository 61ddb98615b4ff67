"""Pairwise-complete second moments for many columns in one pass.

For k columns the pair statistics (n, Σa, Σb, Σa², Σb², Σab over rows where
both are non-null) are four k x k Gram-type matrices.  Each task computes
them for its partition with NumPy (M = not-null mask, Z = shifted values with
zeros at nulls: N = MᵀM, SA = ZᵀM, SAA = (Z∘Z)ᵀM, SAB = ZᵀZ) and emits one row
per pair; a partial+final aggregation sums the partitions.  Output size is
k(k-1)/2 rows regardless of the row count.  Values are shifted by the column
mean first (one small aggregate) so the moment formula does not cancel.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.functions.expr import rnd

_PAIR_SCHEMA = "i int, j int, n double, sa double, sb double, saa double, sbb double, sab double"


def column_means(df: DataFrame, cols: Sequence[str]) -> list[float]:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return [float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i in range(len(cols))]


def pair_moments(df: DataFrame, cols: Sequence[str], shift: Sequence[float] | None = None) -> DataFrame:
    """Rows (i, j, n, sa, sb, saa, sbb, sab) for every i < j, summed over all partitions."""
    cols = list(cols)
    k = len(cols)
    shift = np.asarray(list(shift) if shift is not None else [0.0] * k, dtype="float64")
    iu, ju = np.triu_indices(k, 1)

    def gram(batches):
        acc = None
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan)
            m = (~np.isnan(x)).astype("float64")
            z = np.where(m > 0, x - shift, 0.0)
            parts = (m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z)
            acc = parts if acc is None else tuple(a + b for a, b in zip(acc, parts))
        if acc is None:
            return
        n, sa, saa, sab = acc
        yield pd.DataFrame({"i": iu.astype("int32"), "j": ju.astype("int32"), "n": n[iu, ju],
                            "sa": sa[iu, ju], "sb": sa[ju, iu], "saa": saa[iu, ju], "sbb": saa[ju, iu],
                            "sab": sab[iu, ju]})

    x = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    per_part = x.mapInPandas(gram, _PAIR_SCHEMA)
    return per_part.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ["n", "sa", "sb", "saa", "sbb", "sab"]])


def correlation_pairs(df: DataFrame, cols: Sequence[str], places: int | None = 6) -> DataFrame:
    """Pearson correlation, pairwise-complete (pandas ``DataFrame.corr``), long form.

    Columns: column_a, column_b, i, j (ordinals, i < j), n, corr.  ``corr`` is
    NULL for a constant column or fewer than two complete pairs (N10).
    """
    cols = list(cols)
    mom = pair_moments(df, cols, column_means(df, cols))
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    cov = F.col("sab") - sa * sb / n
    va = F.col("saa") - sa * sa / n
    vb = F.col("sbb") - sb * sb / n
    den = F.sqrt(va * vb)
    # relative guard: a constant column leaves only rounding noise in va / vb
    ok = (n >= 2) & (va > F.col("saa") * 1e-12) & (vb > F.col("sbb") * 1e-12) & (va > 0) & (vb > 0)
    r = F.when(ok, cov / den)
    r = F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)
    names = F.array(*[F.lit(c) for c in cols])
    out = mom.select(F.element_at(names, F.col("i") + 1).alias("column_a"),
                     F.element_at(names, F.col("j") + 1).alias("column_b"),
                     "i", "j", n.cast("long").alias("n"),
                     (rnd(r, places) if places is not None else r).alias("corr"))
    return out
