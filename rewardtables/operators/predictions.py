"""Predicted fields of completions next to their truth."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardtables.functions.parse import tagged_value
from rewardtables.functions.text import xml_answer


def parse_predictions(
    df: DataFrame,
    fields: Mapping[str, tuple[str, Iterable[str]]],
    keep: Sequence[str | Column] = (),
    completion: str = "completion",
) -> DataFrame:
    """Columns ``keep`` and one column per field, ``{out: (tag, allowed values)}``.

    The answer is cut out of the completion once, as a column of its own; the
    fields then look at that short text only.
    """
    answered = df.withColumn("__answer", xml_answer(F.col(completion)))
    parsed = [
        tagged_value(F.col("__answer"), tag, allowed).alias(out)
        for out, (tag, allowed) in fields.items()
    ]
    return answered.select(*keep, *parsed)
