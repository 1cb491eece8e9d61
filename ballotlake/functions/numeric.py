"""Rounding that gives the same digits on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, places: int) -> Column:
    """Round a double by scaling, rounding to a whole number and scaling back.

    Spark's own ``round(x, 2)`` works on the decimal text of ``x`` and differs from
    this for values such as 1.005.
    """
    scale = float(10**places)
    return F.round(value.cast("double") * scale, 0) / F.lit(scale)


def round_half_even(value: Column, places: int) -> Column:
    """As :func:`round_half_up`, with ties going to the even digit."""
    scale = float(10**places)
    return F.rint(value.cast("double") * scale) / F.lit(scale)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``100 * part / whole`` rounded; null where ``whole`` is 0 or null."""
    share = F.lit(100.0) * part / F.when(whole != 0, whole.cast("double"))
    return round_half_up(share, places)


def percent_or_zero(part: Column, whole: Column, places: int = 2) -> Column:
    """As :func:`percent`, but 0.0 where ``whole`` is not positive."""
    return F.when(whole > 0, percent(part, whole, places)).otherwise(F.lit(0.0))


def mean_of_hundredths(value: Column) -> Column:
    """Mean of values with two decimals, added up as whole hundredths.

    The sum is exact, so the result does not depend on the order of the rows.
    """
    hundredths = F.round(value * 100.0, 0).cast("bigint")
    return F.sum(hundredths) / (F.count(value) * F.lit(100.0))
