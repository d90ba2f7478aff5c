"""Band lookups and cuts. The dimensions are Python constants of a few entries, so a
lookup is a CASE expression: no join, no broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rewardtables.constants import BAND_ORDINALS


def lookup(c: Column, table: Mapping[str, float | int]) -> Column:
    """``table[c]``; NULL for a value that the table lacks."""
    out = None
    for key, value in table.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return F.lit(None).cast("double") if out is None else out


def ordinal_of(
    band_type: Column, band: Column, ordinals: Mapping[str, Mapping[str, int]] = BAND_ORDINALS
) -> Column:
    """Ordinal of a band within its type; NULL when unknown."""
    out = None
    for name, table in ordinals.items():
        value = lookup(band, table)
        out = F.when(band_type == name, value) if out is None else out.when(band_type == name, value)
    return out


def band(c: Column, cuts: Sequence[float], names: Sequence[str]) -> Column:
    """Name of the interval that holds ``c``: below ``cuts[0]``, below ``cuts[1]``, …, the rest.

    The cut points have no default. NULL stays NULL; NaN counts as missing.
    """
    if len(names) != len(cuts) + 1:
        raise ValueError("there must be one name more than cut points")
    if list(cuts) != sorted(set(cuts)):
        raise ValueError("cut points must rise")
    value = c.cast("double")
    out = F.when(value.isNull() | F.isnan(value), F.lit(None).cast("string"))
    for cut, name in zip(cuts, names):
        out = out.when(value < F.lit(float(cut)), F.lit(name))
    return out.otherwise(F.lit(names[-1]))
