"""Table source and result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    split: str | None = None,
    fmt: str = "parquet",
    split_col: str = "split",
) -> DataFrame:
    """Read a table with a declared schema, optionally one split of it.

    The split is a partition directory (``split=train``) or a plain column; the
    former prunes directories, the latter row groups. Nothing is inferred but
    the partition column.
    """
    df = spark.read.schema(schema).format(fmt).load(path)
    if split is None:
        return df
    if split_col not in df.columns:
        raise ValueError(f"{path} has no column or partition {split_col!r}")
    return df.where(F.col(split_col) == F.lit(split))


def read_responses(spark: SparkSession, path: str, out: str = "response") -> DataFrame:
    """Logged inference responses, one JSON document per line."""
    return spark.read.text(path).withColumnRenamed("value", out)


def write_results(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a result table as Parquet, in the partitions it has."""
    df.write.mode(mode).parquet(path)


def write_metrics(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write long ``metric, value`` rows as JSON lines."""
    df.write.mode(mode).json(path)
