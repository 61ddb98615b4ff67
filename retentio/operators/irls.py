"""Ridge logistic regression of many groups at once (survey §2.11, T1; base of T3-T5).

One Newton step for every group is one aggregate: the rows meet the current
coefficients of their group, and per group the sums X'WX and X'(W eta + y - mu) come
out as one row, combined before the shuffle, so a group that holds a third of
all rows costs no more than its rows.  Solving is a small array job over one row a
group.  A step that raises a group's loss is halved.  Nothing is collected: the
coefficients are a table (group, n, b0, b1, ...), stored between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.session import stored

GROUP = "_group"


def linear(coefficients: Sequence[Column], x: Sequence[Column]) -> Column:
    """b0 + b1 * x1 + ..., added from left to right."""
    out = coefficients[0]
    for b, v in zip(coefficients[1:], x):
        out = out + b * v
    return out


def logistic(eta: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-eta))


def _newton(p: int, ridge: float, tol: float):
    """Array job over the per-group sums: the coefficients of the next round."""
    pen = np.array([0.0] + [ridge] * (p - 1))

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            now = f[[f"b{i}" for i in range(p)]].to_numpy(float)
            old = f[[f"o{i}" for i in range(p)]].to_numpy(float)
            loss = f["loss"].to_numpy(float) + 0.5 * (now ** 2 * pen).sum(1)
            worse = loss > f["old_loss"].to_numpy(float) * (1 + 1e-12) + 1e-12
            h = np.zeros((len(f), p, p))
            for i in range(p):
                for j in range(i, p):
                    h[:, i, j] = h[:, j, i] = f[f"h{i}_{j}"].to_numpy(float)
            h += np.diag(pen)
            g = f[[f"g{i}" for i in range(p)]].to_numpy(float)
            new = np.stack([np.linalg.lstsq(a, b, rcond=None)[0] for a, b in zip(h, g)]) if len(f) else now
            new = np.where(worse[:, None], (now + old) / 2, new)
            change = np.abs(new - now).max(axis=1) if len(f) else np.zeros(0)
            out = f[[GROUP, "n"]].copy()
            for i in range(p):
                out[f"b{i}"] = new[:, i]
            for i in range(p):
                out[f"o{i}"] = np.where(worse, old[:, i], now[:, i])
            out["old_loss"] = np.where(worse, f["old_loss"].to_numpy(float), loss)
            out["done"] = ~worse & (change <= tol * (1 + np.abs(new).max(axis=1) if len(f) else 0))
            yield out

    return step


def fit_groups(df: DataFrame, group_col: str | None, features: Sequence[str], label: str, ridge: float = 1.0,
               max_iter: int = 50, tol: float = 1e-9) -> DataFrame:
    """(group, n, b0, b1, ...): per group the minimum of log-loss + ridge / 2 * |b1, ...|^2 (b0 is
    not penalised).  Groups whose label takes one value have no row; a NULL feature counts as 0 and
    rows with a NULL label or group are left out.  ``group_col=None`` fits one model."""
    p = len(features) + 1
    key = F.lit(0) if group_col is None else F.col(group_col)
    x = [F.lit(1.0)] + [F.col(f"x{i}") for i in range(1, p)]
    rows = stored(df.select(key.alias(GROUP), F.col(label).cast("double").alias("y"), *[
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features, 1)])
        .where(F.col("y").isNotNull() & F.col(GROUP).isNotNull()), "irls-rows")
    state = rows.groupBy(GROUP).agg(F.count("*").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi")) \
        .where("lo < hi").select(GROUP, "n", *[F.lit(0.0).alias(f"b{i}") for i in range(p)],
                                 *[F.lit(0.0).alias(f"o{i}") for i in range(p)],
                                 F.lit(float("inf")).alias("old_loss"), F.lit(False).alias("done"))
    state = stored(state, "irls")
    eta = linear([F.col(f"b{i}") for i in range(p)], x[1:])
    z = F.col("eta")
    # log(1 + exp(z)) - y z, without overflow
    loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - F.col("y") * z
    sums = [F.sum(F.col("w") * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(p) for j in range(i, p)]
    sums += [F.sum(x[i] * (F.col("w") * z + F.col("y") - F.col("mu"))).alias(f"g{i}") for i in range(p)]
    schema = state.schema
    for _ in range(max_iter):
        open_ = state.where(~F.col("done"))
        if open_.isEmpty():
            break
        moved = (rows.join(open_.select(GROUP, *[f"b{i}" for i in range(p)]), GROUP).withColumn("eta", eta)
                 .withColumn("mu", logistic(z)).withColumn("w", F.col("mu") * (1 - F.col("mu")))
                 .groupBy(GROUP).agg(*sums, F.sum(loss).alias("loss")))
        state = stored(open_.join(moved, GROUP).mapInPandas(_newton(p, ridge, tol), schema)
                       .unionByName(state.where("done")), "irls")
    out = state.select(GROUP, "n", *[f"b{i}" for i in range(p)])
    return out.drop(GROUP) if group_col is None else out.withColumnRenamed(GROUP, group_col)


def terms(fitted: DataFrame, group_col: str, features: Sequence[str]) -> DataFrame:
    """(group, n, term, coefficient): one row per coefficient."""
    names = ["intercept", *features]
    return fitted.select(group_col, "n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("term"), F.col(f"b{i}").alias("coefficient")) for i, c in enumerate(names)])).alias("_t")
    ).select(group_col, "n", "_t.term", "_t.coefficient")
