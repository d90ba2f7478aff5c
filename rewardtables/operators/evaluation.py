"""A whole evaluation, by fold and in total, from one narrow table of parsed examples.

Everything is read off partial states: confusion cells (fold, band type, horizon, truth, prediction) and
the tail states of ``risk.var_cvar_by``. Folds and the total are grouping sets of the same states, so
no example is counted twice and the number of folds costs no further pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.constants import CONFIDENCE
from rewardtables.operators import metrics, risk
from rewardtables.operators.literals import literal_rows
from rewardtables.sources import versions
from rewardtables.sources.scratch import staged

#: (band type, horizon) to its truth and prediction column
Pairs = Mapping[tuple[str, str], tuple[str, str]]

GROUP = ["band_type", "horizon"]


def evaluate(
    parsed: DataFrame,
    pairs: Pairs,
    key: str,
    k_folds: int,
    fold: str = "fold",
    risk_band: str = "returns",
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Long ``fold, metric, value`` rows of every fold 0 … k−1, and of all rows together (fold NULL).

    Band metrics per band type and horizon, VaR and CVaR of the predicted ``risk_band`` per
    horizon. What has no usable row is NULL, not absent. ``parsed`` is read three times: write it first.
    """
    cells = metrics.confusion(metrics.long_pairs(parsed, pairs, by=GROUP, keep=[fold]), [*GROUP, fold])
    cells = staged(cells.withColumnRenamed(fold, "fold"), "cells")
    labels = [*GROUP, "gt", "pred"]
    rolled = cells.groupingSets([[*labels, "fold"], labels], *labels, "fold").agg(F.sum("n").alias("n"))
    every = F.explode(F.concat(F.sequence(F.lit(0), F.lit(k_folds - 1)), F.array(F.lit(None).cast("int"))))
    groups = literal_rows(parsed.sparkSession, list(pairs), "band_type STRING, horizon STRING")
    none = F.lit(None).cast("string")
    zero = groups.select("*", none.alias("gt"), none.alias("pred"), every.alias("fold"), F.lit(0).cast("bigint").alias("n"))
    measured = metrics.metrics_from_confusion(rolled.select(*zero.columns).unionByName(zero), [*GROUP, "fold"])
    bands = metrics.metric_map(measured, by=GROUP, keep=["fold"])

    horizons = [(h, pred) for (band, h), (_, pred) in pairs.items() if band == risk_band]
    cell = [x for h, pred in horizons for x in (F.lit(h), F.col(pred))]
    long = parsed.select(F.col(fold).alias("fold"), F.col(key).alias("id"), F.stack(F.lit(len(horizons)), *cell).alias("horizon", "predicted"))
    tails = risk.var_cvar_by(
        long, ["horizon", "fold"], "predicted", "id", confidence=confidence, sets=[["horizon", "fold"], ["horizon"]]
    )
    wanted = literal_rows(parsed.sparkSession, [(h,) for h, _ in horizons], "horizon STRING").select("horizon", every.alias("fold"))
    same = (wanted["horizon"] == tails["horizon"]) & wanted["fold"].eqNullSafe(tails["fold"])
    tails = wanted.join(tails, same, "left").select(wanted["horizon"], wanted["fold"], "var", "cvar")
    return bands.unionByName(tail_rows(tails, confidence, keep=["fold"]))


def tail_rows(tails: DataFrame, confidence: float = CONFIDENCE, keep: list[str] = []) -> DataFrame:
    """``metric, value`` rows of (horizon, var, cvar); the first year's have the plain names."""
    rows = risk.metric_rows(tails, confidence, keep=[*keep, "horizon"])
    suffix = F.when(F.col("horizon") == "1y", "").otherwise(F.concat(F.lit("_"), "horizon"))
    return rows.select(*keep, F.concat("metric", suffix).alias("metric"), "value")


def append_state(cells: DataFrame, path: str, batch_id: int, by: list[str]) -> bool:
    """Add the confusion cells (``by``, gt, pred, n) of a batch to the state at ``path``, once per batch id.

    The state is a version: its cells, and the ids of the batches in it, are written together and
    switched to together, so a batch is in both or in neither. A repeated batch changes nothing and
    gives False. The state has a row per cell and batch id, however many rows were counted.
    """
    spark = cells.sparkSession
    before = versions.current(spark, path)
    new = cells.select(*by, "gt", "pred", F.col("n").cast("bigint").alias("n"))
    ids = spark.range(0, 1, 1, 1).select(F.lit(batch_id).cast("bigint").alias("batch_id"))
    if before is not None:
        old = spark.read.schema("batch_id BIGINT").parquet(f"{before}/batches")
        if not old.where(F.col("batch_id") == batch_id).isEmpty():
            return False
        ids = old.unionByName(ids)
        new = spark.read.schema(new.schema).parquet(f"{before}/cells").unionByName(new)
    merged = new.groupBy(*by, "gt", "pred").agg(F.sum("n").alias("n"))

    def write(run: str) -> None:
        merged.coalesce(1).write.parquet(f"{run}/cells")
        ids.coalesce(1).write.parquet(f"{run}/batches")

    versions.publish(spark, path, write)
    return True


def state_writer(path: str, by: list[str]) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` on a stream of ``by``, gt, pred rows: keeps their confusion cells."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_state(metrics.confusion(batch, by), path, batch_id, by)

    return write


def read_state(spark, path: str, by: list[str]) -> DataFrame:
    """Confusion cells of all batches in the current state; none before the first."""
    schema = ", ".join(f"`{c}` STRING" for c in by) + ", gt STRING, pred STRING, n BIGINT"
    now = versions.current(spark, path)
    return spark.read.schema(schema).parquet(f"{now}/cells") if now else spark.createDataFrame([], schema)
