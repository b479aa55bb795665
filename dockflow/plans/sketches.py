"""Mergeable quantile sketches of trip durations, per month and segment.

A KLL sketch has a size that depends on ``K`` and hardly on the number of trips, and
sketches of months merge to one of any period, so the median of a period never reads
trips again. Its rank is off by at most :func:`rank_error` of the trips, against the
exact one of :func:`dockflow.operators.analyses.lower_median`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 800


def rank_error(k: int = K, times: float = 3.0) -> float:
    """``times`` the normalised rank error that KLL sketches of size ``k`` stay within 99 % of the time (2.296 / k ** 0.9021)."""
    return times * 2.296 / k**0.9021


def duration_sketches(trips: DataFrame, k: int = K) -> DataFrame:
    """``(trip_month, member_casual, trips, durations)``: some kilobytes for each month and segment."""
    sketch = F.kll_sketch_agg_double("trip_duration_min", F.lit(k)).alias("durations")
    return trips.groupBy("trip_month", "member_casual").agg(F.count(F.lit(1)).alias("trips"), sketch)


def merged_medians(sketches: DataFrame, months: Iterable[str] | None = None, q: float = 0.5, k: int = K) -> DataFrame:
    """``(member_casual, trips, median_duration_min)`` of a period from its months' sketches; all months if none are given."""
    if months is not None:
        sketches = sketches.where(F.col("trip_month").isin(list(months)))
    merged = sketches.groupBy("member_casual").agg(F.sum("trips").alias("trips"), F.kll_merge_agg_double("durations", F.lit(k)).alias("s"))
    return merged.select("member_casual", "trips", F.kll_sketch_get_quantile_double("s", F.lit(q)).alias("median_duration_min"))
