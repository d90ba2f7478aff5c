"""Reproducible randomness: every draw is a hash of its key.

``rand(seed)`` and ``randomSplit`` depend on how rows lie in partitions; these
columns do not, so retried tasks and repartitioned inputs give the same values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13  # hexadecimal digits in one hash number, 52 bits
_RANGE = float(2**52)


def _text(part) -> Column:
    c = part if isinstance(part, Column) else F.lit(str(part))
    # a missing key hashes as the empty text, so its rows are kept
    return F.coalesce(c.cast("string"), F.lit(""))


def digest(*parts) -> Column:
    """md5 of the parts joined by ``:``, as hexadecimal text."""
    joined = [_text(parts[0])]
    for part in parts[1:]:
        joined += [F.lit(":"), _text(part)]
    return F.md5(F.concat(*joined))


def hash_number(hexdigest: Column, which: int = 0) -> Column:
    """The first (0) or second (1) 52-bit number of a digest, as BIGINT."""
    return F.conv(F.substring(hexdigest, 1 + which * _DIGITS, _DIGITS), 16, 10).cast("bigint")


def key_hash(seed, key: Column) -> Column:
    """52-bit number of (seed, key)."""
    return hash_number(digest(seed, key))


def key_unit(seed, key: Column) -> Column:
    """Number in [0, 1) of (seed, key)."""
    return key_hash(seed, key) / F.lit(_RANGE)


def standard_normal(hexdigest: Column) -> Column:
    """Standard normal value from a digest's two numbers (Box-Muller)."""
    u1 = (hash_number(hexdigest, 0) + F.lit(0.5)) / F.lit(_RANGE)
    u2 = (hash_number(hexdigest, 1) + F.lit(0.5)) / F.lit(_RANGE)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
