"""Parsing of tagged fields inside an answer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rewardtables.constants import BAND_ORDINALS, RISK_LEVELS
from rewardtables.functions.text import strip, xml_answer


def tagged_value(answer: Column, tag: str, allowed: Iterable[str]) -> Column:
    """Value of the last ``<tag>…</tag>`` of an answer, lower-cased and stripped.

    NULL unless the tag is present and closed and the value is in ``allowed``.
    """
    opening, closing = f"<{tag}>", f"</{tag}>"
    tail = F.substring_index(answer, opening, -1)
    value = F.lower(strip(F.substring_index(tail, closing, 1)))
    found = answer.contains(opening) & tail.contains(closing)
    return F.when(found & value.isin(list(allowed)), value)


def extract_tagged(c: Column, tag: str, allowed: Iterable[str]) -> Column:
    """``tagged_value`` of a completion's answer."""
    return tagged_value(xml_answer(c), tag, allowed)


def returns_band(c: Column, tag: str = "returns_1y") -> Column:
    return extract_tagged(c, tag, BAND_ORDINALS["returns"])


def volatility_band(c: Column, tag: str = "volatility_1y") -> Column:
    return extract_tagged(c, tag, BAND_ORDINALS["volatility"])


def risk_level(c: Column) -> Column:
    return extract_tagged(c, "risk_level", RISK_LEVELS)
