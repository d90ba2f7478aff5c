"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: documents that a worker handles at once
TEXTS_PER_STEP = 256


def steps(batches: Iterator[pa.RecordBatch], rows: int = TEXTS_PER_STEP) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, so that a worker holds few texts in any form."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def rows_of(*columns: pa.Array, rows: int = TEXTS_PER_STEP) -> Iterator[tuple]:
    """The rows of a batch's columns; only few of them are Python objects at a time."""
    for at in range(0, len(columns[0]), rows):
        yield from zip(*(c.slice(at, rows).to_pylist() for c in columns), strict=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the data directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as no column of the table has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: rows of a few numbers that may be sent to every executor, some 16 MB
FEW_ROWS = 500_000


def few_rows(df: DataFrame) -> DataFrame:
    """The rows, written once, to be broadcast where they are few; larger ones are shuffled."""
    from rewardtables.sources.scratch import staged

    df = staged(df, "side")
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every id that has a link: columns ``id``, ``component``.

    ``links`` has columns ``a`` and ``b``. Each round hangs every neighbour of an id on the
    smallest id of its neighbourhood (large star, then small star); edges stay as many as
    before at most, a hub's work is two partial minima, no id's neighbours are collected.
    Rounds are written to the shared folder; the last one changes nothing.
    """
    from rewardtables.sources.scratch import staged

    edges = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("least"))
        least = least.select("k", F.least("k", "least").alias("least"))
        # large star: larger neighbours of k hang on the least of k's neighbourhood
        large = (
            edges.join(least, edges.b == least.k)
            .select("a", F.col("least").alias("b"))
            .where("a <> b")
        )
        # small star: k and its smaller neighbours hang on the least of k's neighbourhood
        large = large.unionByName(
            least.where("k <> least").select(F.col("k").alias("a"), F.col("least").alias("b"))
        ).distinct()
        least = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("least"))
        small = (
            large.join(least, large.a == least.k)
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .where("a <> b")
            .unionByName(least.select(F.col("k").alias("a"), F.col("least").alias("b")))
            .distinct()
        )
        after = staged(small, "edges")
        # a forest of stars stays as it is: nobody's parent has a parent, nobody has two
        open_ends = after.join(
            after.select(F.col("a").alias("b")).distinct(), "b", "left_semi"
        ).limit(1)
        twice = after.groupBy("a").count().where("count > 1").limit(1)
        edges = after
        if open_ends.unionByName(twice.select("a", F.col("a").alias("b"))).isEmpty():
            break
    else:
        raise RuntimeError(f"components were not closed after {rounds} rounds")
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
