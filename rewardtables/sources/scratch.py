"""Scratch space that every executor can reach."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Without the setting a local session, whose executors live in the driver,
    takes ``SCRATCH_DIR`` or ``/tmp/checkpoints``; any other session is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.environ.get("SCRATCH_DIR", "/tmp/checkpoints").rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read from there: lineage is cut,
    costly inputs are computed a single time, lost executors cost a reread.

    Shuffle files of the write serve nobody afterwards and go when it ends, not when the
    driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
