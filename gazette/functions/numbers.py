"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_tenths(x: Column) -> Column:
    """Round a non-negative double below 2**31 to one decimal place.

    The exact binary value decides and an exact tie goes to the even digit, so
    12.35 (stored as 12.3499...) gives 12.3. ``bround`` decides on the shortest
    decimal text instead and gives 12.4. The fraction is scaled by a power of
    two, which loses nothing, and the rest is integer arithmetic.
    """
    unit = F.lit(1 << 59)
    whole = F.floor(x)
    scaled = ((x - whole) * F.lit(float(1 << 59))).cast("long") * F.lit(10)
    digit = F.shiftright(scaled, 59)
    rest = scaled - digit * unit
    half = F.lit(1 << 58)
    up = (rest > half) | ((rest == half) & (F.pmod(digit, F.lit(2)) == 1))
    return (whole * 10 + digit + up.cast("long")) / F.lit(10.0)


def percent(part: Column, total: Column) -> Column:
    """``part / total * 100`` to one decimal place, 0.0 where there is no total."""
    ratio = F.when(total > 0, part.cast("double") / total.cast("double") * 100)
    return F.coalesce(round_tenths(ratio), F.lit(0.0))
