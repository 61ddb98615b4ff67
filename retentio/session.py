"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "retentio", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and UTC pinned.

    On a cluster ``master`` stays None so spark-submit decides; the shuffle
    partition count is only set when asked (tests / bench size it to cores).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster.

    Read ``spark.checkpoint.dir`` from the session; only when it is unset
    (local tests) fall back to a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="retentio-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """Write ``df`` under the shared checkpoint folder and read it back.  Like a
    checkpoint it ends the lineage; its size is known to the planner, so a small
    table is broadcast by the size check of every join."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/retentio-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
