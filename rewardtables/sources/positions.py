"""Rows of files by their place: for tables and logs that have no key.

The order is that of the files' names as text, then of the rows in a file. It follows from the file, the
start of the block a task reads, and the order of rows in the block; no sort and no window goes over all rows.
Both functions take a frame as ``spark.read`` returns it, with nothing but column choices behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.sources.scratch import staged

_PLACE = {"__file": "_metadata.file_path", "__start": "_metadata.file_block_start"}


def _placed(df: DataFrame) -> DataFrame:
    placed = df.select("*", *[F.col(c).alias(n) for n, c in _PLACE.items()])
    # a block is read by one task in one go, so these ids are consecutive within it
    return placed.withColumn("__row", F.monotonically_increasing_id())


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows: each task keeps its own first ``n``, then these are merged."""
    return _placed(df).orderBy(*_PLACE, "__row").limit(n).drop(*_PLACE, "__row")


def numbered(df: DataFrame, out: str = "position") -> DataFrame:
    """Add the row number, from 0.

    Rows are written once with their block, so that the counts and the numbers come from the same split into
    blocks whatever happens to executors. The driver adds up one count per block: as many as the file splits that it
    has planned. The blocks' offsets are joined back by Spark, which sends them to all tasks only where they are small.
    """
    rows = staged(_placed(df), "placed")
    least, most = F.min("__row").alias("least"), F.max("__row").alias("most")
    blocks = rows.groupBy(*_PLACE).agg(least, most).collect()
    shifts, before = [], 0
    for b in sorted(blocks, key=lambda b: (b["__file"], b["__start"])):
        shifts.append((b["__file"], b["__start"], before - b["least"]))
        before += b["most"] - b["least"] + 1
    table = df.sparkSession.createDataFrame(shifts, "__file STRING, __start BIGINT, __shift BIGINT")
    found = rows.join(table, list(_PLACE))
    return found.withColumn(out, F.col("__row") + F.col("__shift")).drop(*_PLACE, "__row", "__shift")


def pair_rows(left: DataFrame, right: DataFrame, out: str = "position") -> DataFrame:
    """The rows of two tables side by side, first with first; the shorter table ends the result.

    Columns of both and the row number; names must differ.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    return numbered(left, out).join(numbered(right, out), out)
