"""Readers and writers (survey §2.1, S1-S12).

Format is chosen by suffix; a missing path raises FileNotFoundError and an
unknown suffix ValueError.  CSV is read with an explicit schema when one is
given (no inference pass over the data at scale).
"""

from __future__ import annotations

import json
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.operators.clean import schema_diff
from retentio.sources.json_array import read_json_array

READERS = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".pq": "parquet"}


def _suffix(path: str) -> str:
    p = path.rstrip("/").lower()
    for s in READERS:
        if p.endswith(s):
            return s
    return "." + p.rsplit(".", 1)[-1] if "." in p.rsplit("/", 1)[-1] else ""


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p)) if any(ch in path for ch in "*?[") else fs.exists(p)


def load(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV (header), JSON (arrays of objects, cut at byte ranges), Parquet by suffix."""
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    fmt = READERS.get(_suffix(path))
    if fmt is None:
        raise ValueError(f"Unsupported file format: {path}")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("inferSchema", schema is None).csv(path)
    if fmt == "json":
        return read_json_array(spark, path, schema)
    return r.parquet(path)


def load_pair(spark: SparkSession, train_path: str, holdout_path: str, schema=None) -> tuple[DataFrame, DataFrame]:
    """Both tables; a schema difference is reported as a warning."""
    train, holdout = load(spark, train_path, schema), load(spark, holdout_path, schema)
    diff = schema_diff(train, holdout)
    if diff["only_in_first"] or diff["only_in_second"]:
        warnings.warn(f"train/holdout columns differ: {diff}")
    return train, holdout


def schema_diff_frame(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """S6 as a table: (column, side) for columns present on one side only."""
    d = schema_diff(a, b)
    rows = [(c, "first") for c in d["only_in_first"]] + [(c, "second") for c in d["only_in_second"]]
    return spark.createDataFrame(rows, "column string, side string")


def save(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Parquet for .parquet, CSV (with header) otherwise - unknown suffixes fall back to CSV."""
    if _suffix(path) in (".parquet", ".pq"):
        df.write.mode(mode).parquet(path)
        return "parquet"
    df.write.mode(mode).option("header", True).csv(path)
    return "csv"


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """All splits (train / val / holdout) in one Parquet dataset partitioned by split."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_predictions(df: DataFrame, path: str) -> str:
    """S9."""
    return save(df, path)


def write_threshold(spark: SparkSession, path: str, model: str, threshold: float, metrics: dict) -> None:
    """One-row JSON record with the model name, threshold and metrics."""
    spark.createDataFrame([(model, float(threshold), json.dumps(metrics, default=float))],
                          "model string, threshold double, metrics string").coalesce(1) \
        .write.mode("overwrite").json(path)


def synthetic_churn(spark: SparkSession, n: int = 1000, seed: int = 42, num_partitions: int | None = None) -> DataFrame:
    """Demo table (feature_0..9, monthly_charges, tenure_months, total_charges,
    num_services, customer_id, Churn) generated with seeded ``rand``/``randn`` and a
    logistic label rule; rows are generated on the executors (spark.range)."""
    base = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    cols = [F.randn(seed + i).alias(f"feature_{i}") for i in range(10)]
    df = base.select(F.col("id").alias("customer_id"), *cols,
                     (20 + F.rand(seed + 10) * 100).alias("monthly_charges"),
                     F.floor(1 + F.rand(seed + 11) * 72).cast("int").alias("tenure_months"),
                     F.floor(1 + F.rand(seed + 12) * 8).cast("int").alias("num_services"))
    df = df.withColumn("total_charges", F.col("monthly_charges") * F.col("tenure_months"))
    z = (0.5 * F.col("feature_0") - 0.3 * F.col("feature_1") + 0.02 * (F.col("monthly_charges") - 70)
         - 0.04 * (F.col("tenure_months") - 36) + 0.1 * (F.col("num_services") - 4))
    p = 1 / (1 + F.exp(-z))
    return df.withColumn("Churn", (F.rand(seed + 13) < p).cast("int"))
