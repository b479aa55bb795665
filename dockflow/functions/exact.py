"""Means and shares from integer sums, rounded half up without floating point.

A double sum depends on the order of its terms, so a mean that lies exactly on
a rounding boundary could fall on either side from run to run. Whole seconds
and metres add up exactly in any order, and the rounding below compares
integers only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_half_up(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` of whole numbers, rounded half away from zero to ``scale`` digits; NULL where ``den`` is 0 or NULL.

    ``2 * 10**scale * num`` must fit a 64-bit integer.
    """
    p = 10**scale
    num, den = num.cast("long"), F.nullif(den.cast("long"), F.lit(0).cast("long"))
    units = F.call_function("div", F.lit(2 * p).cast("long") * F.abs(num) + den, F.lit(2).cast("long") * den)
    return F.when(num < 0, -units).otherwise(units) / F.lit(float(p))


def whole_seconds(duration_min: Column) -> Column:
    """Seconds of a duration in minutes that came from whole seconds."""
    return F.round(duration_min * F.lit(60.0)).cast("long")


def whole_metres(distance_km: Column) -> Column:
    """Metres of a distance in kilometres with three decimals."""
    return F.round(distance_km * F.lit(1000.0)).cast("long")


def mean_minutes(seconds_sum: Column, n: Column, scale: int = 2) -> Column:
    return ratio_half_up(seconds_sum, n * F.lit(60), scale)


def mean_km(metres_sum: Column, n: Column, scale: int = 2) -> Column:
    return ratio_half_up(metres_sum, n * F.lit(1000), scale)


def percent(part: Column, whole: Column, scale: int) -> Column:
    return ratio_half_up(part * F.lit(100), whole, scale)
