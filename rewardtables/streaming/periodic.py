"""Periodic evaluation of scored rollouts: by step in batch, by time on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rewardtables.constants import EVAL_EVERY, EVAL_SAMPLES
from rewardtables.functions import rewards
from rewardtables.functions.hashing import key_hash, key_unit
from rewardtables.sources import deltas

_SLOT_BITS = 10

_SCORES = {
    "correctness": lambda: rewards.correctness(F.col("completion"), F.col("answer")),
    "strict_format": lambda: rewards.strict_format(F.col("completion")),
    "length": lambda: rewards.length(F.col("completion")),
}


def score(df: DataFrame) -> DataFrame:
    """Add the three built-in rewards for ``completion`` and ``answer``; stateless, so fit for streams."""
    return df.withColumns({f"reward_{name}": make() for name, make in _SCORES.items()})


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("reward_correctness") > 0).cast("int")).alias("accuracy"),
        *[F.avg(f"reward_{name}").alias(f"mean_{name}") for name in _SCORES],
    ]


def _least(df: DataFrame, keys: list[str], order: list[str], samples: int) -> DataFrame:
    """The first ``samples`` rows of each group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.where(F.col("__rank") <= F.lit(samples)).drop("__rank")


def _bounded(df: DataFrame, samples: int) -> DataFrame:
    """Rows whose hash isn't above a bound that at least ``samples`` rows of their bucket keep.

    Each task counts its rows by bucket and by the hash's leading bits, a table of fixed size
    per bucket; the sums tell the slot that the last sample lies in. So about
    ``samples`` rows and a slot's worth of others are shuffled, for any number of samples.
    """
    slot = F.shiftright("__hash", 52 - _SLOT_BITS).cast("int")
    counts = df.groupBy("eval_step", slot.alias("__slot")).agg(F.count(F.lit(1)).alias("__n"))
    so_far = Window.partitionBy("eval_step").orderBy("__slot")
    reached = counts.withColumn("__before", F.sum("__n").over(so_far) - F.col("__n"))
    last = reached.where(F.col("__before") < F.lit(samples)).groupBy("eval_step")
    last = last.agg(F.max("__slot").alias("__last"))
    return df.join(last, "eval_step").where(slot <= F.col("__last")).drop("__last")


def sample_per_bucket(
    df: DataFrame,
    step: str,
    key: str,
    every: int = EVAL_EVERY,
    samples: int = EVAL_SAMPLES,
    seed: int = 42,
) -> DataFrame:
    """The ``samples`` rows of each ``every``-step bucket with the least key hash.

    Adds ``eval_step``, the bucket's first step. A bucket that spans every task of a
    large job is cut where its rows are: see ``_bounded``.
    """
    number = F.col(step).cast("bigint")
    hashed = df.withColumns(
        {
            "eval_step": number - F.pmod(number, F.lit(every)),
            "__hash": key_hash(seed, F.col(key)),
        }
    )
    cut = _bounded(hashed, samples)
    return _least(cut, ["eval_step"], ["__hash", key], samples).drop("__hash")


def periodic_eval(
    df: DataFrame,
    step: str,
    every: int = EVAL_EVERY,
    samples: int = EVAL_SAMPLES,
    key: str = "event_id",
    seed: int = 42,
) -> DataFrame:
    """Accuracy and mean rewards of a fixed-size sample per ``every`` steps.

    Rows need ``completion`` and ``answer``; only sampled rows are scored.
    """
    sampled = sample_per_bucket(df, step, key, every, samples, seed)
    return score(sampled).groupBy("eval_step").agg(*_measures())


def periodic_eval_stream(
    df: DataFrame,
    ts: str,
    window: str,
    watermark: str,
    fraction: float = 1.0,
    key: str = "event_id",
    seed: int = 42,
) -> DataFrame:
    """Accuracy and mean rewards per time window over a hash sample of the rows.

    Works alike on a stream and on a batch table. On a stream the state is one
    row per open window; rows later than ``watermark`` are dropped by Spark's
    watermark rule. ``ts`` must be a TIMESTAMP (cast a zone-less one first).
    """
    sampled = df.where(key_unit(seed, F.col(key)) < F.lit(float(fraction)))
    if df.isStreaming:
        sampled = sampled.withWatermark(ts, watermark)
    measured = score(sampled).groupBy(F.window(ts, window)).agg(*_measures())
    return measured.select(
        F.col("window.start").alias("window_start"), *[c for c in measured.columns if c != "window"]
    )


def start_windows(
    windows: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Start writing a stream's windows to ``path``, each whenever it has changed.

    A window's state goes once the watermark closes it, so state stays bounded; windows that
    are open when a finite input ends have been written, too. A micro-batch that is run again
    changes nothing. ``read_windows`` has the last state of each; older states go when folders are merged.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        deltas.append(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), path, batch_id, _last_windows)

    writer = windows.writeStream.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.outputMode("update").foreachBatch(add).start()


def _last_windows(written: DataFrame) -> DataFrame:
    """Each window as the latest batch has it."""
    values = F.struct(*written.columns)
    return written.groupBy("window_start").agg(F.max_by(values, "batch_id").alias("w")).select("w.*")


def read_windows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every window that ``start_windows`` has written, once, as it was last."""
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return _last_windows(deltas.read(spark, path, stored)).drop("batch_id")


def sample_writer(
    path: str,
    step: str,
    key: str,
    every: int = EVAL_EVERY,
    samples: int = EVAL_SAMPLES,
    seed: int = 42,
    merge_every: int = deltas.EVERY,
):
    """A ``foreachBatch`` function that keeps the candidates for the exact sample of all batches.

    A bucket's least hashes over all batches lie among the least of each batch, so
    ``samples`` rows per bucket and batch are enough. Folders of batches are merged now and then to as many
    rows per bucket, so what is stored grows with the buckets, not with the batches. A
    batch that is run again changes nothing.
    """

    def least(rows: DataFrame) -> DataFrame:
        return sample_per_bucket(rows, step, key, every, samples, seed).drop("eval_step").select(rows.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        deltas.append(least(batch), path, batch_id, least, merge_every)

    return write


def sampled_eval(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    step: str,
    key: str,
    every: int = EVAL_EVERY,
    samples: int = EVAL_SAMPLES,
    seed: int = 42,
) -> DataFrame:
    """``periodic_eval`` over the candidates of ``sample_writer``: equal to it over all rows.

    ``schema`` is that of the stream.
    """
    return periodic_eval(deltas.read(spark, path, schema), step, every, samples, key, seed)
