"""Token-id array expressions and checkpoint names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: directory name of a checkpoint; "(?d)" as in the format reward
CHECKPOINT_NAME = "(?d)^checkpoint-([0-9]+)$"

RESPONSE_SCHEMA = (
    "completion_ids ARRAY<ARRAY<INT>>, outputs ARRAY<STRUCT<token_ids: ARRAY<INT>>>"
)


def _filled(c: Column) -> Column:
    return c.isNotNull() & (F.size(c) > 0)


def fill_empty(ids: Column, eos_id: int) -> Column:
    """``[eos]`` in place of an empty or missing sequence."""
    return F.when(_filled(ids), ids).otherwise(F.array(F.lit(eos_id)))


def parse_response(json: Column) -> Column:
    """A logged response as a struct with both layouts' fields."""
    return F.from_json(json, RESPONSE_SCHEMA)


def response_ids(parsed: Column, eos_id: int) -> Column:
    """Sequences of a parsed response in either layout; never empty, nor any of them.

    A non-empty ``completion_ids`` wins, else ``outputs[*].token_ids``; a response
    with neither gives ``[[eos]]``.
    """
    direct, outputs = parsed["completion_ids"], parsed["outputs"]
    chosen = (
        F.when(_filled(direct), direct)
        .when(_filled(outputs), F.transform(outputs, lambda o: o["token_ids"]))
        .otherwise(F.array(F.array(F.lit(eos_id))))
    )
    return F.transform(chosen, lambda ids: fill_empty(ids, eos_id))


def pad_to(ids: Column, size: Column, pad_id: int) -> Column:
    """Right-pad to ``size``."""
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.greatest(size - F.size(ids), F.lit(0))))


def append_ids(prompt: Column, completion: Column) -> Column:
    """Prompt ids followed by completion ids."""
    return F.concat(prompt, completion)


def ensure_new_token(inp: Column, out: Column, eos_id: int | None, pad_id: int | None) -> Column:
    """Append one token to an output that is no longer than its input.

    The token is eos, or pad where eos is missing or zero, or zero.
    """
    filler = eos_id or pad_id or 0
    return F.when(F.size(out) == F.size(inp), F.concat(out, F.array(F.lit(filler)))).otherwise(out)


def checkpoint_digits(name: Column) -> Column:
    """Step of a checkpoint directory name as text without leading zeros; empty for other names."""
    return F.regexp_replace(F.regexp_extract(name, CHECKPOINT_NAME, 1), "^0+(?=[0-9])", "")


def checkpoint_step(name: Column) -> Column:
    """Step of a checkpoint directory name as BIGINT; NULL for other names and larger numbers."""
    return checkpoint_digits(name).try_cast("bigint")


def zip_shortest(left: Column, right: Column) -> Column:
    """Pairs of two arrays up to the shorter one's end (``arrays_zip`` alone pads with NULL)."""
    n = F.least(F.size(left), F.size(right))
    return F.zip_with(
        F.slice(left, F.lit(1), n),
        F.slice(right, F.lit(1), n),
        lambda a, b: F.struct(a.alias("left"), b.alias("right")),
    )
