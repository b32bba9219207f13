"""Repeatable noise.

Values come from a hash of the row's own keys, so a task that runs again after a
lost executor produces the same rows, whatever partition they are in.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits, exact in a double
_RANGE = float(16**_HEX_DIGITS)


def _digest(stream: str, keys: tuple[Column, ...]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(stream), *[k.cast("string") for k in keys]))


def _fraction(digest: Column, start: int) -> Column:
    digits = F.substring(digest, start, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(_RANGE)


def uniform(stream: str, *keys: Column) -> Column:
    """Number in [0, 1) determined by the stream name and the keys."""
    return _fraction(_digest(stream, keys), 1)


def gaussian(stream: str, *keys: Column) -> Column:
    """Standard normal number (Box-Muller on two hash fractions)."""
    digest = _digest(stream, keys)
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _fraction(digest, 1)))
    return radius * F.cos(F.lit(2.0 * math.pi) * _fraction(digest, 1 + _HEX_DIGITS))


def uniform_integer(stream: str, low: int, high: int, *keys: Column) -> Column:
    """Integer between ``low`` and ``high``, both included."""
    return (F.lit(low) + F.floor(uniform(stream, *keys) * F.lit(high - low + 1))).cast("int")
