"""Storing the frames of the level loops, and the size check before a broadcast.

Every frame a loop carries to the next round is written as a table below the
session's ``spark.checkpoint.dir`` and read back.  That cuts the logical plan
*and* the lineage: each round plans against stored data only, a lost executor
costs no recomputation of earlier rounds, and a later reader can prune columns.
``release`` deletes a table that no later round needs.

Only persisting would not be enough: a round's plan would then contain the
plans of all earlier rounds, and measured on Spark 4.1 each round got slower
than the last as earlier rounds were re-run inside adaptive plans.

The folder comes from the session and must be shared by all executors; the
library never invents one (``session.local_session`` does, for tests).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_BROADCAST_BYTES = 10 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share (HDFS, S3, ...)")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def durable(df: DataFrame, count: bool = False) -> tuple[DataFrame, int | None]:
    """Store ``df`` (computed once) and return the stored frame, plus its row
    count when asked (from the stored files)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._canopy_path = path
    return stored, (stored.count() if count else None)


def release(*frames: DataFrame | None) -> None:
    """Delete the tables behind frames from ``durable`` (others are left alone)."""
    for df in frames:
        path = getattr(df, "_canopy_path", None)
        if path:
            sc = df.sparkSession.sparkContext
            target = sc._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def broadcast_bytes(spark: SparkSession, explicit: int | None = None) -> int:
    """Largest measured size we are willing to broadcast: the session's
    ``spark.sql.autoBroadcastJoinThreshold`` (-1 disables: 0 bytes)."""
    if explicit is not None:
        return max(int(explicit), 0)
    raw = (spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None) or str(DEFAULT_BROADCAST_BYTES)).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    number, factor = raw, 1
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            number, factor = raw[: -len(suffix)], units[suffix]
            break
    try:
        return max(int(float(number) * factor), 0)
    except ValueError:
        return DEFAULT_BROADCAST_BYTES
