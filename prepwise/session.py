"""Session helpers: a local session for tests/bench, and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark (a cluster passes its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("prepwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PREPWISE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


BATCH_BYTES = 4 << 20      # of cells sent to a Python worker at a time; one longer cell goes alone


def bound_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by bytes, not by rows alone: ten thousand long texts at once, and their
    results, would take a Python worker's memory.  A tighter bound of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = spark.conf.get(key, None)
    if not (have or "").isdigit() or int(have) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is set by the operator and only read here.  Only when it
    is unset (local tests) a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
    path = tempfile.mkdtemp(prefix="prepwise-ckpt-")      # local mode only (tests, bench)
    sc.setCheckpointDir(path)
    return path
