"""Session settings for a given input size."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 2**20
#: more blocks than this squared are more than drivers and shuffle services keep track of
MOST_PARTITIONS = 20_000


def settings(input_bytes: int, cores: int, shuffled_bytes: int | None = None) -> dict[str, str]:
    """Settings that keep a task's share near 128 MiB and let adaptive execution do the rest.

    The shuffle starts with enough partitions for what is shuffled (a fifth of the input
    unless told), but ``MOST_PARTITIONS`` at most; scans of very large inputs
    take larger splits for the same reason. Adaptive execution merges small partitions
    afterwards and splits hot ones in joins.
    """
    shuffled = input_bytes // 5 if shuffled_bytes is None else shuffled_bytes
    partitions = max(cores, math.ceil(shuffled / PARTITION_BYTES))
    partitions = min(partitions, max(cores, MOST_PARTITIONS))
    split = max(PARTITION_BYTES, math.ceil(input_bytes / max(cores, 5 * MOST_PARTITIONS)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.session.timeZone": "UTC",
        # call-site capture for error messages takes about half the time of building a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def configure(
    builder: SparkSession.Builder, input_bytes: int, cores: int
) -> SparkSession.Builder:
    """A session builder with these settings."""
    for name, value in settings(input_bytes, cores).items():
        builder = builder.config(name, value)
    return builder
