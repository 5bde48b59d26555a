"""Spark session helpers.

The engine never owns cluster configuration: on a cluster the session comes
from the platform. ``local_session`` is for tests and the bench only.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rolefeed") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ROLEFEED_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is read as is; it is
    an error if it is missing. Only a session on this machine alone (tests,
    local runs) gets a scratch folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not d:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        d = tempfile.mkdtemp(prefix="rolefeed-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(d)
    return d


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
