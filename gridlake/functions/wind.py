"""Vector magnitude and meteorological direction, and the exact-lag amount."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_magnitude(u: Column, v: Column) -> Column:
    """Length of (u, v)."""
    return F.sqrt(u * u + v * v)


def vector_direction(u: Column, v: Column) -> Column:
    """Degrees the wind blows from: 0 = north, 90 = east; calm counts as 180."""
    degrees = F.degrees(F.atan2(-u, -v)) + F.lit(360.0)
    return F.when((u == 0) & (v == 0), F.lit(180.0)).otherwise(degrees % F.lit(360.0))


def amount(now: Column, before: Column) -> Column:
    """Increase of a run total; a decrease counts as zero, a missing side stays missing."""
    return now - F.when(before > now, now).otherwise(before)


def clamp_negative(x: Column) -> Column:
    """Negative values become zero; missing stays missing."""
    return F.when(x < 0, F.lit(0)).otherwise(x)
