"""Session for tests, benchmarks and scripts (library code never builds one)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "canopy", event_log_dir: str | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CANOPY_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:  # stage and task times for tools/stage_times.py
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's ``spark.checkpoint.dir``; only when none is set
    (local tests) create a fresh scratch folder for it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = tempfile.mkdtemp(prefix="canopy-ckpt-")
    sc.setCheckpointDir(current)
    return current
