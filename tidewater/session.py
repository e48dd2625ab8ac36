"""Session helpers for tests, the bench and command-line runs.

Library functions never build or reconfigure a session; they take the one the
caller has. These helpers only exist so that tests and the bench start Spark
the same way.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "tidewater",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Return the cluster's checkpoint directory, setting ``fallback`` only
    when the session has none (tests and local runs).

    On a cluster ``spark.checkpoint.dir`` names a shared, reliable folder; a
    machine-local folder must never be used there.
    """
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    target = conf_dir or fallback
    spark.sparkContext.setCheckpointDir(target)
    return spark.sparkContext.getCheckpointDir() or target


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``. Where a
    session names none, a local one gets a temporary folder, and one on a cluster
    a folder beside its warehouse, which executors share."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        fallback = tempfile.mkdtemp(prefix="tidewater-")
    else:
        fallback = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidewater_scratch"
    return ensure_checkpoint_dir(spark, fallback).rstrip("/")
