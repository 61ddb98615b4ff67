"""Per-customer sequences and short-horizon forecasts (survey §2.11, T2-T7).

Input: a panel (id, t, vector columns..., label) with one row per customer and
period (``usage_series`` aggregates events to that grain, so a customer's
group is bounded by its number of periods).  Windows are Spark window frames
partitioned by customer; there is no per-customer Python loop.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentio.functions.expr import rnd


def sequences(df: DataFrame, id_col: str, time_col: str, vec_cols: Sequence[str], label: str,
              window: int = 3) -> DataFrame:
    """Every run of ``window`` consecutive rows of a customer, flattened to
    ``x{step}_{col}`` columns, labelled with the label of the row that follows.
    Customers with fewer than window + 1 rows yield nothing."""
    w = Window.partitionBy(id_col).orderBy(time_col)
    cols = {}
    for s in range(window):
        back = window - 1 - s
        for c in vec_cols:
            cols[f"x{s}_{c}"] = F.lag(F.col(c).cast("double"), back).over(w) if back else F.col(c).cast("double")
    nxt = F.lead(F.col(label), 1).over(w)
    rn = F.row_number().over(w)
    out = df.select(id_col, F.col(time_col).alias("t_end"), *[v.alias(k) for k, v in cols.items()],
                    nxt.alias("label_next"), rn.alias("_rn"))
    return out.where((F.col("_rn") >= window) & F.col("label_next").isNotNull()).drop("_rn")


def linear_window_score(vec_cols: Sequence[str], window: int, coefficients: Sequence[float], intercept: float,
                        frame: Sequence[Column]) -> Column:
    """Logistic score of a flattened window: sigmoid(b + sum w_i x_i) (the T3 scorer form)."""
    z = F.lit(float(intercept))
    for w_, x in zip(coefficients, frame):
        z = z + F.lit(float(w_)) * x
    return 1.0 / (1.0 + F.exp(-z))


def forecast(df: DataFrame, id_col: str, time_col: str, vec_cols: Sequence[str], coefficients: Sequence[float],
             intercept: float, window: int = 3, periods: int = 3, time_kind: str = "numeric") -> DataFrame:
    """For each customer with >= ``window`` rows, score the latest window, then
    slide it by appending the LAST OBSERVED vector (not the forecast) ``periods - 1``
    times.  Future time labels: numeric last + k, timestamp last + k months, else k;
    'last' is the maximum time in the panel."""
    w = Window.partitionBy(id_col).orderBy(F.desc(time_col))
    ranked = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= window)
    cnt = Window.partitionBy(id_col)
    ranked = ranked.withColumn("_n", F.count("*").over(cnt)).where(F.col("_n") >= window)
    # one row per customer holding its last `window` vectors (r = 1 is the latest)
    agg = ranked.groupBy(id_col).agg(*[
        F.max(F.when(F.col("_r") == r, F.col(c).cast("double"))).alias(f"v{r}_{c}")
        for r in range(1, window + 1) for c in vec_cols])
    steps = agg.select("*", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("period"))

    def slot(s: int, c: str) -> Column:
        # step k (1-based) shifts by k-1: slot s of the window holds row r = window - s + (k - 1)
        # counted from the latest; past the latest it repeats the last observed vector (r = 1)
        r = F.lit(window - s) - (F.col("period") - 1)
        expr = F.col(f"v1_{c}")
        for rr in range(2, window + 1):
            expr = F.when(r == rr, F.col(f"v{rr}_{c}")).otherwise(expr)
        return expr

    frame = [slot(s, c) for s in range(window) for c in vec_cols]
    prob = linear_window_score(vec_cols, window, coefficients, intercept, frame)
    last = df.select(F.max(time_col)).scalar()
    if time_kind == "numeric":
        t = last + F.col("period")
    elif time_kind == "timestamp":
        t = F.add_months(last, F.col("period"))
    else:
        t = F.col("period")
    return steps.select(id_col, t.alias(time_col), rnd(prob).alias("forecast_prob"), "period")


def score_series(df: DataFrame, id_col: str, time_col: str, vec_cols: Sequence[str], coefficients: Sequence[float],
                 intercept: float, fallback: Column, window: int = 3) -> DataFrame:
    """T4: score each row from its trailing window; the first window-1 rows of a
    customer (and customers shorter than the window) fall back to ``fallback``."""
    w = Window.partitionBy(id_col).orderBy(time_col)
    frame = []
    for s in range(window):
        back = window - 1 - s
        for c in vec_cols:
            frame.append(F.lag(F.col(c).cast("double"), back).over(w) if back else F.col(c).cast("double"))
    seq = linear_window_score(vec_cols, window, coefficients, intercept, frame)
    rn = F.row_number().over(w)
    return df.select(id_col, time_col, F.when(rn >= window, seq).otherwise(fallback).alias("score"))


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-x))
