"""Spark session construction and shared-storage helpers."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on. AQE re-plans joins and
# shuffle sizes at runtime (skew splitting, partition coalescing); the
# session zone is UTC because raw-zone dates are UTC dates.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Broadcast only what the planner can prove small; dimension joins in
    # this package add explicit hints only for fixed lookups.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # AQE coalesces small shuffle partitions towards this size and splits
    # skewed ones above the skew threshold. The size is that of compressed rows: narrow ones
    # (a key, a date, a number) take ten times as much in a task's sorts and hash maps
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(32 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}

TARGET_SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "paylake") -> SparkSession:
    """Local/test session. On a cluster, use the cluster's session and call
    :func:`configure` on it instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PAYLAKE_DRIVER_MEM", "8g"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def tune_for_input(spark: SparkSession, input_bytes: int, min_partitions: int = 200) -> int:
    """Size the initial shuffle for an input of ``input_bytes``: about
    200 MB of input per shuffle partition (so a partition's sort buffer fits
    an executor core's memory share), never fewer than ``min_partitions``;
    AQE then coalesces what turns out small. For 100 TB that is ~500,000
    partitions before coalescing. Returns the number set."""
    n = max(min_partitions, -(-input_bytes // TARGET_SHUFFLE_PARTITION_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A directory under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names a folder every executor can reach. It is
    read from the session. Spark does not let it be set on a running session, so
    where it is unset (local tests) a scratch folder is given to the context,
    which remembers it for later calls.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="paylake-ckpt-"))
        base = sc.getCheckpointDir()
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path
