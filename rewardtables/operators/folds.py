"""Summary of per-fold metrics, held as long rows ``(fold, metric, value)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, fold: str = "fold") -> DataFrame:
    """Wide fold rows to long ones; columns other than ``fold`` are metrics."""
    metrics = [c for c in df.columns if c != fold]
    cells = [x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))]
    stacked = F.stack(F.lit(len(metrics)), *cells).alias("metric", "value")
    return df.select(F.col(fold).cast("int").alias("fold"), stacked)


def append_folds(*wide: DataFrame) -> DataFrame:
    """Append wide fold tables with differing columns; absent ones become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wide)


def summarise(df: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of each metric over folds.

    NaN counts as missing, as NULL does; one value gives a NULL deviation.
    """
    value = F.when(~F.isnan("value"), F.col("value"))
    return df.groupBy("metric").agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std_dev")
    )


def missing_folds(df: DataFrame, k_folds: int) -> DataFrame:
    """Expected folds 0 … k−1 without a row."""
    expected = df.sparkSession.range(0, k_folds, 1, 1).select(F.col("id").cast("int").alias("fold"))
    found = df.select(F.col("fold").cast("int").alias("fold")).distinct()
    return expected.join(found, "fold", "left_anti")


def fold_status(df: DataFrame, k_folds: int) -> DataFrame:
    """Every expected fold with whether it was found."""
    expected = df.sparkSession.range(0, k_folds, 1, 1).select(F.col("id").cast("int").alias("fold"))
    found = df.groupBy(F.col("fold").cast("int").alias("fold")).agg(F.lit(True).alias("found"))
    return expected.join(found, "fold", "left").select(
        "fold", F.coalesce("found", F.lit(False)).alias("found")
    )
