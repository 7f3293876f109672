"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators count on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    created = tempfile.mkdtemp(prefix="obsframe-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; never reused, never cleared."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def written_once(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several branches read, and read it back.

    Cuts the lineage with a table in the shared folder, so that a lost executor
    costs a re-read and not a re-run.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
