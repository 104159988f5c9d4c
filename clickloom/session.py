"""What the library needs from the caller's Spark session."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """All hours, days and months are UTC, so the session has to be too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the checkpoint folder that all executors share, which the cluster
    names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/clickloom-{purpose}-{uuid.uuid4().hex}"
