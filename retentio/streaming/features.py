"""Structured Streaming: the row-wise feature projection on a stream.

Derived features (§2.5) and fitted transforms are stateless projections, so
they run unchanged on a streaming DataFrame.  ``stream_features`` reads new
Parquet files as they land, appends features and writes them out with a
checkpoint (exactly-once file sink); ``run_available`` drains what is there
now (``availableNow`` trigger) and returns the written table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from retentio.operators import features as FE


def stream_features(spark: SparkSession, source: str, schema, out_path: str, checkpoint: str,
                    names: Iterable[str] | None = None, families: Iterable[str] | None = None,
                    keep: Iterable[str] = ("CustomerID",), max_files_per_trigger: int = 64,
                    available_now: bool = True) -> StreamingQuery:
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source)
    names = list(names) if names is not None else [n for f in (families or FE.FAMILIES) for n in FE.family_members(f)]
    out = stream.select(*keep, *FE.feature_columns(stream, names))
    w = out.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def run_available(spark: SparkSession, source: str, schema, out_path: str, checkpoint: str, **kw) -> DataFrame:
    q = stream_features(spark, source, schema, out_path, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(out_path)
