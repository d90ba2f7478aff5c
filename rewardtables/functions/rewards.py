"""Reward expressions over completion text, one double per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rewardtables.constants import CORRECT_REWARD, FORMAT_REWARD, STRICT_FORMAT, TARGET_LENGTH
from rewardtables.functions.text import xml_answer


def correctness(completion: Column, answer: Column) -> Column:
    """2.0 when the extracted answer equals ``answer`` exactly, else 0.0 (also for NULL)."""
    return F.when(xml_answer(completion) == answer, F.lit(CORRECT_REWARD)).otherwise(F.lit(0.0))


def strict_format(completion: Column) -> Column:
    """0.5 for the strict layout with one line of reasoning and one of answer, else 0.0.

    ``(?d)`` makes the line feed the only line end for ``.`` and ``$``; without
    it a carriage return or U+2028 would also count as one.
    """
    return F.when(completion.rlike("(?d)" + STRICT_FORMAT), F.lit(FORMAT_REWARD)).otherwise(
        F.lit(0.0)
    )


def length(completion: Column, target: int = TARGET_LENGTH) -> Column:
    """Minus the distance of the text's length (in code points) from ``target``."""
    return (-F.abs(F.lit(target) - F.char_length(completion))).cast("double")
