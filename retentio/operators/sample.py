"""Splits, folds, resampling and class weights (survey §2.7, R1-R11).

Row order inside a class is a seeded shuffle key with the id as tiebreaker:
``hash`` (any id type) or ``modular`` (integer ids; arithmetic an SQL engine can
repeat).  Ranks within a class come from ``row_index`` - slice-wise running
counts - because a class is a huge group (one label can hold most rows) and a
window partitioned by the label would put it in a single task.

A row whose label is NULL belongs to no class: splits and folds return it with
a NULL split or fold, resampling leaves it as it is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.plans.ordering import row_index

# Fixed values of the modular shuffle key: (id * multiplier + seed) mod modulus.
SHUFFLE_MULTIPLIER, SHUFFLE_MODULUS = 7919, 1000003


def shuffle_key(id_col: str, seed: int = 42, shuffle: str = "hash") -> Column:
    """Seeded order key; ``modular`` is valid for ids below 2^63 / 7919 (about 1.1e15)."""
    if shuffle == "hash":
        return F.xxhash64(F.col(id_col), F.lit(seed))
    if shuffle == "modular":
        return (F.col(id_col) * SHUFFLE_MULTIPLIER + seed) % SHUFFLE_MODULUS
    raise ValueError(f"no such shuffle: {shuffle}")


def class_counts(df: DataFrame, label: str) -> dict:
    """{class: n} without NULL, from one partial aggregation (bounded by the number of classes)."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect() if r[0] is not None}


def _ranked(df: DataFrame, id_col: str, label: str | None, seed: int, shuffle: str) -> DataFrame:
    keyed = df.withColumn("_key", shuffle_key(id_col, seed, shuffle))
    groups = [label] if label else []
    return row_index(keyed, ["_key", id_col], groups, name="_rank").drop("_key")


def _half_up(x: float) -> int:
    return int(math.floor(x + 0.5))


def _per_class(values: dict, label: str) -> Column:
    """The value of a row's class; NULL for a NULL label."""
    out = F.lit(None).cast("long")
    for c, v in values.items():
        out = F.when(F.col(label) == F.lit(c), F.lit(v)).otherwise(out)
    return out


def stratified_split(df: DataFrame, id_col: str, label: str, test_frac: float = 0.2, seed: int = 42,
                     stratify: bool = True, shuffle: str = "hash") -> DataFrame:
    """Adds ``split`` = 'test' for the first round(n_c * frac) rows of each
    class in shuffle order (of all rows when ``stratify=False``), else 'train'."""
    if stratify:
        cut = _per_class({c: _half_up(n * test_frac) for c, n in class_counts(df, label).items()}, label)
    else:
        cut = F.lit(_half_up(df.count() * test_frac))
    ranked = _ranked(df, id_col, label if stratify else None, seed, shuffle)
    return ranked.withColumn("split", F.when(F.col("_rank") <= cut, "test").when(cut.isNotNull(), "train")).drop("_rank")


def three_way_split(df: DataFrame, id_col: str, label: str, temp_frac: float = 0.3, seed: int = 42,
                    shuffle: str = "hash") -> DataFrame:
    """70/15/15 - a stratified 30 % temp part, halved into test and val."""
    temp = {c: _half_up(n * temp_frac) for c, n in class_counts(df, label).items()}
    test = _per_class({c: _half_up(t * 0.5) for c, t in temp.items()}, label)
    r = F.col("_rank")
    ranked = _ranked(df, id_col, label, seed, shuffle)
    return ranked.withColumn("split", F.when(r <= test, "test").when(r <= _per_class(temp, label), "val")
                             .when(test.isNotNull(), "train")).drop("_rank")


def stratified_kfold(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42,
                     shuffle: str = "hash") -> DataFrame:
    """``fold`` = (rank within class - 1) mod k."""
    ranked = _ranked(df, id_col, label, seed, shuffle)
    fold = F.when(F.col(label).isNotNull(), ((F.col("_rank") - 1) % k).cast("int"))
    return ranked.withColumn("fold", fold).drop("_rank")


def is_binary(df: DataFrame, label: str) -> tuple[bool, dict]:
    counts = class_counts(df, label)
    return len(counts) == 2, counts


def undersample(df: DataFrame, id_col: str, label: str, ratio: float = 1.0, seed: int = 42,
                shuffle: str = "hash") -> DataFrame:
    """Keep every minority row and the first int(n_min / ratio) majority rows.
    R8: a label that is not binary leaves the frame unchanged."""
    binary, counts = is_binary(df, label)
    if not binary:
        return df
    (minority, n_min), (majority, n_maj) = sorted(counts.items(), key=lambda kv: (kv[1], kv[0]))
    target = int(n_min / ratio)
    if target >= n_maj:
        return df
    ranked = _ranked(df.where(F.col(label) == majority), id_col, None, seed, shuffle)
    kept = ranked.where(F.col("_rank") <= target).drop("_rank")
    return df.where((F.col(label) == minority) | F.col(label).isNull()).unionByName(kept)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    g = df.groupBy(label).agg(F.count("*").alias("count"))
    tot = df.select(F.count("*")).scalar()
    k = df.select(F.countDistinct(label)).scalar()
    return g.select(label, "count", (tot / (k * F.col("count"))).alias("weight"))


def with_weight_column(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Attach the balanced class weight as ``weightCol`` (literal map over the classes)."""
    rows = class_weights(df, label).collect()
    m = F.create_map(*[x for r in rows for x in (F.lit(r[label]), F.lit(float(r["weight"])))])
    return df.withColumn(name, m[F.col(label)])


def scale_pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives / positives, 1.0 when there is no positive."""
    agg = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos"))
    return agg.select("neg", "pos", F.when(F.col("pos") > 0, F.col("neg") / F.col("pos")).otherwise(1.0)
                      .alias("scale_pos_weight"))


def distribution_before_after(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Class counts and shares before and after resampling."""
    def dist(df, stage):
        tot = df.select(F.count("*")).scalar()
        return df.groupBy(label).agg(F.count("*").alias("count")).select(
            F.lit(stage).alias("stage"), label, "count", (F.col("count") * 100.0 / tot).alias("pct"))
    return dist(before, "before").unionByName(dist(after, "after"))


def resample(df: DataFrame, id_col: str, label: str, features: Sequence[str], strategy: str = "none",
             ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """Strategy switch used by the training workflow: none | undersample | smote | hybrid."""
    if strategy == "none":
        return df
    if strategy == "undersample":
        return undersample(df, id_col, label, ratio, seed)
    from retentio.operators.smote import smote, hybrid
    if strategy == "smote":
        return smote(df, id_col, label, features, ratio, seed=seed)
    if strategy == "hybrid":
        return hybrid(df, id_col, label, features, ratio, seed=seed)
    raise ValueError(f"Unsupported resampling strategy: {strategy}")
