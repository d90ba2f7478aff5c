"""Rollout tables: advantages, response logs, padding, checkpoint lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.functions import tokens
from rewardtables.operators.grouped import with_group_stats


def group_advantage(
    df: DataFrame,
    group: str,
    reward: str,
    eps: float = 1e-4,
    scale: bool = True,
    out: str = "advantage",
) -> DataFrame:
    """Add (reward − group mean) / (group standard deviation + eps).

    The deviation is the sample one, 0 for a single row. ``scale=False`` leaves
    the division out.
    """
    stats = {"__mean": F.avg(reward)}
    if scale:
        stats["__std"] = F.coalesce(F.stddev_samp(reward), F.lit(0.0))
    joined = with_group_stats(df, group, **stats)
    value = F.col(reward) - F.col("__mean")
    if scale:
        value = value / (F.col("__std") + F.lit(eps))
    return joined.withColumn(out, value).drop(*stats)


def normalise_responses(
    df: DataFrame, json_col: str, eos_id: int, out: str = "completion_ids"
) -> DataFrame:
    """Add the token sequences of a logged response, whichever layout it has."""
    # a column of its own, so that each document is parsed once
    parsed = df.withColumn("__parsed", tokens.parse_response(F.col(json_col)))
    return parsed.withColumn(out, tokens.response_ids(F.col("__parsed"), eos_id)).drop("__parsed")


def explode_sequences(
    df: DataFrame, ids_col: str = "completion_ids", position: str = "pos", out: str = "seq"
) -> DataFrame:
    """One row per sequence of a normalised response, in place of the array column.

    The outer form: those arrays are never empty, and the inner form's inferred
    filter would be pushed below the JSON parsing and parse again.
    """
    others = [c for c in df.columns if c != ids_col]
    return df.select(*others, F.posexplode_outer(ids_col).alias(position, out))


def pad_batch(
    df: DataFrame, ids_col: str, batch_col: str, pad_id: int, out: str = "padded_ids"
) -> DataFrame:
    """Add each sequence right-padded to its batch's longest; a missing one counts as empty."""
    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    joined = with_group_stats(df, batch_col, __longest=F.max(F.size(ids)))
    return joined.withColumn(out, tokens.pad_to(ids, F.col("__longest"), pad_id)).drop("__longest")


def latest_checkpoint(
    manifest: DataFrame,
    run_col: str = "run",
    name_col: str = "name",
    is_dir_col: str = "is_dir",
    path_col: str = "path",
) -> DataFrame:
    """Per run the path, name (``latest``) and step of the directory with the greatest step.

    Runs without a candidate give no row.

    Steps compare as whole numbers of any length: by digit count, then digits.
    ``step`` itself is a BIGINT, NULL where it does not fit.
    """
    name = F.col(name_col)
    digits = tokens.checkpoint_digits(name).alias("__step")
    candidates = manifest.where(
        F.coalesce(F.col(is_dir_col), F.lit(False)) & name.rlike(tokens.CHECKPOINT_NAME)
    ).select(run_col, name_col, path_col, digits)
    rank = F.struct(F.length("__step"), F.col("__step"), name, F.col(path_col))
    best = candidates.groupBy(run_col).agg(F.max(rank).alias("__best"))
    latest = F.col(f"__best.{name_col}")
    return best.select(
        run_col, F.col(f"__best.{path_col}").alias("path"), latest.alias("latest"),
        tokens.checkpoint_step(latest).alias("step"),
    )
