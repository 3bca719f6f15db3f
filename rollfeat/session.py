"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "rollfeat", master: str | None = None, initial_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package relies on. Sizes are left to the cluster and adaptive execution.

    Adaptive execution merges small shuffle partitions but never makes more of them, so a large cluster should begin with
    many: give ``initial_partitions`` about the largest shuffle over 128 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **({} if initial_partitions is None else {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial_partitions)}),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates, weekdays and timestamps without zone are all read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may do without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rollfeat-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
