"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.session import checkpoint_dir

#: a word: a run of characters other than the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"

#: stands for a NULL id inside the operators; sorts before every real id
NULL_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text, unchanged; a NULL text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage ends at files every executor sees."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def list_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat int64 values, offsets) of a list<int64> Arrow array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    return flat, (offsets - offsets[0]).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hashes(h: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values, by doubling: O(log size)
    vector passes.  Runs that cross a document border are the caller's to skip."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, length, factor = h.astype(np.uint64), 1, np.uint64(base)
    out, offset, rest = None, 0, size
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                piece = power[offset:offset + n]
                out = piece.copy() if out is None else out * factor + piece
                offset += length
            rest >>= 1
            if rest:
                power = power[:-length] * factor + power[length:]
                factor = factor * factor
                length *= 2
        return mix64(out)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every run of ``size`` values, by doubling."""
    n = len(x) - size + 1
    if n <= 0:
        return np.empty(0, x.dtype)
    cur, length = x, 1
    while length * 2 <= size:
        cur = np.minimum(cur[:-length], cur[length:])
        length *= 2
    return np.minimum(cur[:n], cur[size - length:size - length + n])
