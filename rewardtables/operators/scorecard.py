"""Reward registry and per-completion scorecard."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rewardtables.functions import rewards
from rewardtables.functions.text import first_content

Reward = Callable[[Mapping[str, Column]], Column]

_REGISTRY: dict[str, Reward] = {}


def register(name: str, reward: Reward) -> None:
    """Register a reward: a function from named columns to one DOUBLE column."""
    _REGISTRY[name] = reward


def registered() -> list[str]:
    return sorted(_REGISTRY)


register("correctness", lambda c: rewards.correctness(c["completion"], c["answer"]))
register("strict_format", lambda c: rewards.strict_format(c["completion"]))
register("length", lambda c: rewards.length(c["completion"]))


def python_reward(fn: Callable[..., Sequence[float]], columns: Mapping[str, str]) -> Reward:
    """Wrap a Python reward that takes column lists by keyword and returns a list of numbers.

    ``columns`` maps the function's keyword to the scorecard's column name, for
    instance ``{"completions": "raw_completion", "answer": "answer"}``. Calls go
    through Arrow batches; nested columns arrive as lists of dicts.
    """
    keywords = list(columns)

    @F.arrow_udf(T.DoubleType())
    def call(*arrays: pa.Array) -> pa.Array:
        values = fn(**{k: a.to_pylist() for k, a in zip(keywords, arrays)})
        return pa.array([None if v is None else float(v) for v in values], pa.float64())

    return lambda c: call(*[c[columns[k]] for k in keywords])


def completion_text(df: DataFrame, column: str) -> Column:
    """Completion text of either shape: a string, or a message list's first content."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return first_content(F.col(column))
    return F.col(column)


def pair(completions: DataFrame, answers: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Pair completions with gold answers by an explicit key; unpaired rows drop out."""
    return completions.join(answers, [key] if isinstance(key, str) else list(key), "inner")


def scorecard(
    df: DataFrame, names: Sequence[str], own: Mapping[str, Reward] | None = None, **cols: str
) -> DataFrame:
    """Add ``reward_<name>`` for each named reward, and their sum ``reward_total``.

    ``own`` has rewards that only this call knows, beside the registered ones. ``cols`` renames inputs (``completion="text"``). Rewards see ``completion``
    as text and the untouched column as ``raw_completion``.
    """
    source = {"completion": "completion", **cols}
    inputs = {name: F.col(name) for name in df.columns}
    inputs.update({name: F.col(column) for name, column in cols.items()})
    inputs["raw_completion"] = F.col(source["completion"])
    inputs["completion"] = completion_text(df, source["completion"])
    known = {**_REGISTRY, **(own or {})}
    scored = df.withColumns({f"reward_{n}": known[n](inputs) for n in names})
    total = reduce(lambda a, b: a + b, [F.col(f"reward_{n}") for n in names])
    return scored.withColumn("reward_total", total)


def scorecard_summary(df: DataFrame, by: str | Sequence[str], names: Sequence[str]) -> DataFrame:
    """Row count and mean of each reward and of the total, per group."""
    by = [by] if isinstance(by, str) else list(by)
    means = [F.avg(f"reward_{n}").alias(f"mean_{n}") for n in [*names, "total"]]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *means)
