"""Group statistics next to every row, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_stats(df: DataFrame, keys: str | Sequence[str], **stats: Column) -> DataFrame:
    """Add aggregate columns of each row's group.

    A window over ``keys`` would put a whole group into one task. Here the
    groups are aggregated (with map-side partial sums) and joined back: when the
    statistics are small at run time the join becomes a broadcast by Spark's own
    size check, otherwise it is a sort-merge join whose hot partitions adaptive
    execution splits. Null-safe keys keep the rows of a NULL group, and their
    exchange leaves both join inputs as plain shuffle reads, which skew
    splitting needs.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    renamed = {k: f"__group_{k}" for k in keys}
    grouped = df.groupBy(*[F.col(k).alias(renamed[k]) for k in keys]).agg(
        *[c.alias(name) for name, c in stats.items()]
    )
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys]
    )
    return df.join(grouped, same, "left").drop(*renamed.values())
