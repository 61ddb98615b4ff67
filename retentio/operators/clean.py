"""Cleaning operators (survey §2.3, C1-C13).

Fit = one distributed aggregate whose result is bounded by the number of
columns (medians, modes, means, bounds); the fitted values live in a frozen
dataclass and transform is a single projection with those values as
literals.  Fitting on train and replaying on holdout is therefore exact and
never re-derives statistics from the holdout (except where the reference
explicitly does: C4 fallback, C6 self-imputation).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.functions.expr import rnd
from retentio.plans.ordering import quantile_row
from retentio.session import stored

# ----------------------------------------------------------------- C1 / C13


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-numeric text -> NULL (``to_numeric(errors='coerce')``), other columns kept."""
    cols = set(cols)
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


# Target labels of the churn column.
TARGET_POSITIVE, TARGET_NEGATIVE = "Yes", "No"


def map_target(df: DataFrame, target: str = "Churn", name: str | None = None) -> DataFrame:
    """Yes -> 1, No -> 0, anything else -> NULL (int)."""
    t = F.col(target)
    y = F.when(t == TARGET_POSITIVE, F.lit(1)).when(t == TARGET_NEGATIVE, F.lit(0)).otherwise(F.lit(None).cast("int"))
    name = name or target
    if name == target:
        return df.select(*[y.alias(name) if c == target else F.col(c) for c in df.columns])
    return df.select(*[F.col(c) for c in df.columns if c != name], y.alias(name))


# ----------------------------------------------------------------- C2


def null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    cols = list(cols or df.columns)
    row = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    n = row["__n"]
    return {c: (row[c] / n if n else 0.0) for c in cols}


@dataclass(frozen=True)
class SparseColumnDrop:
    threshold: float
    shares: dict[str, float]

    @property
    def dropped(self) -> list[str]:
        return [c for c, s in self.shares.items() if s * 100 > self.threshold * 100]

    def transform(self, df: DataFrame) -> DataFrame:
        drop = set(self.dropped)
        return df.select(*[c for c in df.columns if c not in drop])


def fit_drop_sparse(df: DataFrame, threshold: float = 0.7, cols: Sequence[str] | None = None) -> SparseColumnDrop:
    """Columns whose null share is above ``threshold``; decided at fit, replayed on holdout."""
    return SparseColumnDrop(threshold, null_shares(df, cols))


def sparse_decision_table(df: DataFrame, threshold: float = 0.7, cols: Sequence[str] | None = None) -> DataFrame:
    """C2 as a table: column, null_pct, dropped (one aggregate, long form)."""
    cols = list(cols or df.columns)
    row = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    st = [F.struct(F.lit(c).alias("column"), (F.col(f"m{i}") * 100.0 / F.col("n")).alias("null_pct"))
          for i, c in enumerate(cols)]
    long = row.select(F.explode(F.array(*st)).alias("r")).select("r.*")
    return long.select("column", rnd(F.col("null_pct")).alias("null_pct"),
                       (F.col("null_pct") > threshold * 100).alias("dropped"))


# ----------------------------------------------------------------- C3-C7


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value per column, ties -> smallest.

    Partial aggregation to distinct (column, value) counts, then a bounded
    ``min(struct(-count, value))`` per column: no per-group value map.
    Numeric columns are compared as numbers, the others as strings.
    """
    cols = list(cols)
    if not cols:
        return {}
    types = dict(df.dtypes)
    numeric = [c for c in cols if types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    out = {c: None for c in cols}
    for group, cast in ((numeric, "double"), ([c for c in cols if c not in numeric], "string")):
        if not group:
            continue
        long = (df.select(*[F.col(c).cast(cast).alias(c) for c in group])
                .unpivot([], group, "column", "value").where(F.col("value").isNotNull()))
        counts = long.groupBy("column", "value").agg(F.count("*").alias("cnt"))
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value"))).alias("b"))
        for r in best.collect():                      # one row per column
            out[r["column"]] = _restore(r["b"]["value"], types[r["column"]])
    return out


def _restore(v, dtype: str):
    if v is None:
        return None
    if dtype in ("double", "float"):
        return float(v)
    if dtype in ("int", "bigint", "smallint", "tinyint"):
        return int(float(v))
    return v


@dataclass(frozen=True)
class Imputer:
    """Fitted fill values per column; ``transform`` is one ``coalesce`` projection."""
    values: dict[str, object]
    strategy: str = "median"

    def transform(self, df: DataFrame, fallback: Sequence[str] = ()) -> DataFrame:
        """Fill NULLs with the fitted values; columns listed in ``fallback``
        that were not fitted use the frame's own statistic (C4)."""
        fill = dict(self.values)
        missing = [c for c in fallback if c in df.columns and fill.get(c) is None]
        if missing:
            fill.update(_own_stats(df, missing, self.strategy))
        types = dict(df.dtypes)
        return df.select(*[F.coalesce(F.col(c), F.lit(fill[c]).cast(types[c])).alias(c)
                           if fill.get(c) is not None else F.col(c) for c in df.columns])


def _own_stats(df: DataFrame, cols: Sequence[str], strategy: str) -> dict[str, object]:
    if strategy == "median":
        return {c: q[0] for c, q in quantile_row(df, cols, [0.5]).items()}
    if strategy == "mean":
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    return modes(df, cols)


def fit_median_imputer(df: DataFrame, cols: Sequence[str]) -> Imputer:
    """Exact (interpolated) medians of the train table."""
    return Imputer(_own_stats(df, list(cols), "median"), "median")


def fit_mean_imputer(df: DataFrame, cols: Sequence[str]) -> Imputer:
    """C7 numeric part: train means for the second pass on holdout."""
    return Imputer(_own_stats(df, list(cols), "mean"), "mean")


def fit_mode_imputer(df: DataFrame, cols: Sequence[str]) -> Imputer:
    """Most frequent value (ties -> smallest) for categorical / binary columns."""
    return Imputer(modes(df, list(cols)), "mode")


def impute_self(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Each table imputed with its own medians / modes."""
    med = fit_median_imputer(df, numeric)
    mod = fit_mode_imputer(df, categorical)
    return mod.transform(med.transform(df))


def second_pass(df: DataFrame, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Remaining NULLs on holdout <- train mean (numeric) / train mode (categorical)."""
    return fit_mode_imputer(train, categorical).transform(fit_mean_imputer(train, numeric).transform(df))


# ----------------------------------------------------------------- C8-C11


def _moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    row = df.agg(*[x for c in cols for x in (F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                                             F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def _z_outlier(c: str, mean, std, threshold: float):
    if mean is None or std is None or std == 0:
        return F.lit(False)
    return F.abs((F.col(c) - mean) / std) > threshold


@dataclass(frozen=True)
class OutlierClip:
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        def clip(c):
            lo, hi = self.bounds[c]
            x = F.col(c)
            return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x).alias(c)
        return df.select(*[clip(c) if c in self.bounds else F.col(c) for c in df.columns])


def fit_outlier_clip(df: DataFrame, cols: Sequence[str], threshold: float = 3.0) -> OutlierClip:
    """For columns with any |z| > threshold, clip to [q1 - 1.5 IQR, q3 + 1.5 IQR] (NULL kept).

    Three column-bounded aggregates: moments, outlier flags, quartiles.
    """
    cols = list(cols)
    mom = _moments(df, cols)
    flags = df.agg(*[F.count_if(_z_outlier(c, *mom[c], threshold)).alias(c) for c in cols]).first()
    flagged = [c for c in cols if flags[c] > 0]
    if not flagged:
        return OutlierClip({})
    q = quantile_row(df, flagged, [0.25, 0.75])
    bounds = {}
    for c in flagged:
        q1, q3 = q[c]
        iqr = q3 - q1
        bounds[c] = (q1 - 1.5 * iqr, q3 + 1.5 * iqr)
    return OutlierClip(bounds)


#: share of the threshold beyond which a row is a suspect, and the share of a column's variance
#: that has to be left for its moments to be downdated
SUSPECT, VARIANCE_LEFT = 0.85, 1e-6


def _downdated(df: DataFrame, cols: Sequence[str], threshold: float) -> list[tuple[str, float | None, float | None]]:
    """(column, mean, std) for a prefix of ``cols`` (at least one), each on the rows that the columns before it keep.

    Two scans: the moments of all columns, and the suspects, rows near or beyond the threshold of some column, which
    are stored.  The moments of a later column are those of the scan less the removed rows, all of them suspects.  The
    prefix ends where a row that is no suspect could be an outlier by the new moments, or where too little variance is
    left for the difference to be exact."""
    cols = list(cols)
    row = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"n{i}"), F.avg(F.col(c).cast("double")).alias(f"m{i}"),
        F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}"))]).first()
    found = [(c, row[f"n{i}"], row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)]
    done = [(cols[0], found[0][2], found[0][3])]
    if len(cols) == 1:
        return done
    near = F.lit(False)
    for c, _, m, s in found:
        near = near | F.coalesce(_z_outlier(c, m, s, SUSPECT * threshold), F.lit(False))
    suspects = stored(df.select(*cols).where(near), "outlier-suspects")
    removed = F.lit(False)
    for (c, n, m, s), before in zip(found[1:], found):
        removed = removed | F.coalesce(_z_outlier(before[0], *done[-1][1:], threshold), F.lit(False))
        if s is None or s == 0:                       # constant on all rows, so on those that are left
            done.append((c, m, s))
            continue
        d = F.col(c).cast("double") - F.lit(m)
        gone = suspects.where(removed).agg(F.count(d).alias("n"), F.sum(d).alias("d"), F.sum(d * d).alias("q")).first()
        left, squares = n - gone["n"], (n - 1) * s * s
        if left < 2:
            return done
        shift = -(gone["d"] or 0.0) / left
        rest = squares - (gone["q"] or 0.0) - left * shift * shift
        if not rest > VARIANCE_LEFT * squares:
            return done
        std, safe = (rest / (left - 1)) ** 0.5, SUSPECT * threshold * s
        if not abs(shift) + safe <= threshold * std:
            return done
        done.append((c, m + shift, std))
    return done


def sequential_outlier_rules(df: DataFrame, cols: Sequence[str], threshold: float = 3.0) -> list[tuple[str, float | None, float | None]]:
    """(column, mean, std) of every column on the rows that the columns before it keep."""
    rules, rest = [], list(cols)
    while rest:
        done = _downdated(_without_outliers(df, rules, threshold), rest, threshold)
        rules, rest = rules + done, rest[len(done):]
    return rules


def _without_outliers(df: DataFrame, rules, threshold: float) -> DataFrame:
    for c, m, s in rules:
        df = df.where(~F.coalesce(_z_outlier(c, m, s, threshold), F.lit(False)))
    return df


def remove_outliers(df: DataFrame, cols: Sequence[str], threshold: float = 3.0, mode: str = "sequential") -> DataFrame:
    """Drop rows with |z| > threshold.

    ``sequential`` (reference): column by column, later columns' mean/std are
    taken on the already-reduced frame (N15), downdated from one scan.
    ``joint``: all z-scores from the full frame, one aggregate.
    """
    cols = list(cols)
    if mode == "joint":
        mom = _moments(df, cols)
        return _without_outliers(df, [(c, *mom[c]) for c in cols], threshold)
    return _without_outliers(df, sequential_outlier_rules(df, cols, threshold), threshold)


@dataclass(frozen=True)
class OutlierImpute:
    rules: dict[str, tuple[float, float, float]] = field(default_factory=dict)   # mean, std, median
    threshold: float = 3.0

    def transform(self, df: DataFrame) -> DataFrame:
        def fix(c):
            m, s, med = self.rules[c]
            return F.when(F.coalesce(_z_outlier(c, m, s, self.threshold), F.lit(False)), F.lit(med)).otherwise(F.col(c)).alias(c)
        return df.select(*[fix(c) if c in self.rules else F.col(c) for c in df.columns])


def fit_outlier_impute(df: DataFrame, cols: Sequence[str], threshold: float = 3.0) -> OutlierImpute:
    """Outliers (|z| > threshold) replaced by the column median."""
    cols = list(cols)
    mom = _moments(df, cols)
    flags = df.agg(*[F.count_if(_z_outlier(c, *mom[c], threshold)).alias(c) for c in cols]).first()
    flagged = [c for c in cols if flags[c] > 0]
    med = quantile_row(df, flagged, [0.5]) if flagged else {}
    return OutlierImpute({c: (mom[c][0], mom[c][1], med[c][0]) for c in flagged}, threshold)


def handle_outliers(df: DataFrame, cols: Sequence[str], treatment: str = "clip", threshold: float = 3.0,
                    is_train: bool = True, train_only: bool = True) -> DataFrame:
    """C11 switch: 'none' | 'clip' | 'remove' | 'impute'; with ``train_only`` holdout passes through."""
    if treatment == "none" or (train_only and not is_train):
        return df
    if treatment == "clip":
        return fit_outlier_clip(df, cols, threshold).transform(df)
    if treatment == "remove":
        return remove_outliers(df, cols, threshold)
    if treatment == "impute":
        return fit_outlier_impute(df, cols, threshold).transform(df)
    raise ValueError(f"unknown outlier treatment: {treatment}")


# ----------------------------------------------------------------- C12


def align_features(df: DataFrame, train_columns: Sequence[str], fill=0) -> DataFrame:
    """train's columns in train's order; missing ones filled with ``fill``, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in train_columns])


def schema_diff(a: DataFrame | Sequence[str], b: DataFrame | Sequence[str]) -> dict[str, list[str]]:
    """Columns only in ``a`` / only in ``b`` (set arithmetic on names, order of first frame)."""
    ca = list(a.columns) if isinstance(a, DataFrame) else list(a)
    cb = list(b.columns) if isinstance(b, DataFrame) else list(b)
    return {"only_in_first": [c for c in ca if c not in set(cb)],
            "only_in_second": [c for c in cb if c not in set(ca)]}
