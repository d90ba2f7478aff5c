"""Fold metric files: one JSON object per fold.

``publish_fold_metrics`` writes all folds as one version, which readers see as a whole or not at all.
``write_fold_metrics`` is for readers of the plain layout ``base_dir/fold_{i}/evaluation_metrics.json``.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardtables.sources import versions
from rewardtables.sources.schemas import FOLD_METRICS

# fixed values: directory prefix and file name
_DIR = "fold_"
_FILE = "evaluation_metrics.json"


def read_fold_metrics(spark: SparkSession, base_dir: str, k_folds: int) -> DataFrame:
    """Long ``(fold, metric, value)`` rows of the folds 0 … k−1 that have a file.

    Where versions were published the current one is read, else the plain layout. Every key of a
    file becomes a row, so folds may differ in keys. Absent folds are skipped; no file at all gives no rows. A value that is no number is NULL
    (true and false count as 1 and 0); a file that is no JSON object is an error.
    """
    run = versions.current(spark, base_dir)
    pattern = f"{run}/fold=*/part-*" if run else f"{base_dir.rstrip('/')}/{_DIR}*/{_FILE}"
    try:
        files = spark.read.text(pattern, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FOLD_METRICS)
    name = F.regexp_extract(
        F.col("_metadata.file_path"), f"/{'fold=' if run else _DIR}(0|[1-9][0-9]*)/[^/]*$", 1
    )
    # as texts: with DOUBLE values one odd value would void its whole file
    metrics = F.from_json("value", "MAP<STRING, STRING>", {"mode": "FAILFAST"})
    rows = (
        files.select(name.try_cast("int").alias("fold"), "value")
        .where(F.col("fold") < F.lit(k_folds))
        .select("fold", F.explode(metrics).alias("metric", "value"))
    )
    text = F.btrim("value", F.lit('"'))
    number = F.when(text == "true", 1.0).when(text == "false", 0.0).otherwise(text.try_cast("double"))
    return rows.withColumn("value", number)


def _texts(df: DataFrame) -> DataFrame:
    """One row per fold: fold, value, the JSON object of its metrics; NaN as null.

    A fold has a handful of metrics: the map is as large as one file's content.
    """
    value = F.when(~F.isnan("value"), F.col("value"))
    entries = F.array_sort(F.collect_list(F.struct(F.col("metric"), value)))
    return df.groupBy("fold").agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def publish_fold_metrics(df: DataFrame, base_dir: str, keep: int = 2) -> str:
    """Write long ``(fold, metric, value)`` rows as a new version of all folds, then switch to it.

    A reader before the switch sees the version before, one after it this one; neither sees a
    part. Spark writes a directory per fold; the driver does one rename, whatever the number of folds.
    """
    write = lambda path: _texts(df).write.partitionBy("fold").text(path)
    return versions.publish(df.sparkSession, base_dir, write, keep)


def write_fold_metrics(df: DataFrame, base_dir: str) -> None:
    """Write long ``(fold, metric, value)`` rows as one plain file per fold, replacing older ones.

    Spark writes the JSON texts, a directory per fold, next to their place on the
    same file system; each is then renamed to its name, which replaces the older file at once.
    """
    spark = df.sparkSession
    base = base_dir.rstrip("/")
    staging = f"{base}/.staging-{uuid.uuid4().hex}"
    _texts(df).write.partitionBy("fold").text(staging)  # grouped: a fold lies in one task, one file

    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(hadoop.Path(f"{staging}/fold=*/part-*")):
        source = status.getPath()
        fold = source.getParent().getName().split("=", 1)[1]
        target = hadoop.Path(f"{base}/{_DIR}{fold}/{_FILE}")
        fs.mkdirs(target.getParent())
        versions.replace(spark, source, target)
    fs.delete(hadoop.Path(staging), True)
