"""Session settings the jobs rely on, and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# UTC so that instants print and compare the same everywhere; duplicate JSON
# keys keep the last value, as common JSON parsers do; tables are stored small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session and return it."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the session names: ``spark.checkpoint.dir`` or its checkpoint folder.

    There is no other choice of a folder: one that only this machine sees would
    fail on a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
