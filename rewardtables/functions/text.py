"""Text extraction and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rewardtables.constants import (
    ANSWER_CLOSE,
    ANSWER_OPEN,
    HASH_MARK,
    INST_CLOSE,
    PY_WHITESPACE,
)


def strip(c: Column) -> Column:
    """Remove the Unicode white space at both ends that Python's ``strip`` removes.

    Spark's one-argument ``trim`` takes off U+0020 only.
    """
    return F.btrim(c, F.lit(PY_WHITESPACE))


def xml_answer(c: Column) -> Column:
    """Text after the last ``<answer>`` up to the next ``</answer>``, stripped.

    Without tags this is the stripped text itself.
    """
    tail = F.substring_index(c, ANSWER_OPEN, -1)
    return strip(F.substring_index(tail, ANSWER_CLOSE, 1))


def hash_answer(c: Column) -> Column:
    """Text between the first and the second ``####``, stripped; NULL without a mark.

    ``split`` rather than ``substring_index``: the latter counts overlapping
    matches, so a run of five ``#`` would hold two marks.
    """
    return strip(F.get(F.split(c, HASH_MARK, 3), F.lit(1)))


def after_marker(c: Column, marker: str = INST_CLOSE) -> Column:
    """Text after the last ``marker`` (the whole text without one), stripped."""
    return strip(F.substring_index(c, marker, -1))


def render_cot(reasoning: Column, answer: Column) -> Column:
    """Reasoning and answer in the tagged layout that the format reward accepts."""
    return F.concat(
        F.lit("<reasoning>\n"),
        reasoning,
        F.lit("\n</reasoning>\n" + ANSWER_OPEN + "\n"),
        answer,
        F.lit("\n" + ANSWER_CLOSE + "\n"),
    )


def message(role: str, content: Column) -> Column:
    """One chat message as ``STRUCT<role, content>``."""
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def first_content(c: Column) -> Column:
    """Content of a message list's first message; NULL for an empty list."""
    return F.get(c, F.lit(0))["content"]


def last_content(c: Column) -> Column:
    """Content of a message list's last message; NULL for an empty list."""
    return F.get(c, F.size(c) - 1)["content"]


last_user_text = last_content
