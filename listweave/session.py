"""Session helpers: session defaults and durable checkpoints."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: The setting that names the folder all executors share.
CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app: str = "listweave", cores: str | None = None) -> SparkSession:
    """A session for tests and the local bench. On a cluster the caller brings
    a session and its own sizing."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LISTWEAVE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session whose executors
    live in the driver's own process may do without the setting."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set(CHECKPOINT_DIR, own)
    return own


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder, so the iteration that
    follows neither replays its history nor depends on one executor's disk."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
