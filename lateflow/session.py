"""Spark session and shared-folder helpers.

Everything runs in UTC: windows align to the Unix epoch and dates are UTC dates.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lateflow") -> SparkSession:
    """A session configured for event-time work.

    On a cluster, pass nothing: master, shuffle partitions and the checkpoint folder
    come from the cluster's configuration. Locally (tests, bench) pass ``local[N]``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of DataFrames that are gone are removed from the shared folder
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage, from ``spark.checkpoint.dir`` (or the
    context's checkpoint folder). Only a local session may go without: it gets a fresh
    temporary folder, as driver and executors are one process there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lateflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
