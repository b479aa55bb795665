"""Chart feeds: the data shaping behind each report chart, as DataFrames.

Rendering is left to the caller; each feed is a small ordered result derived
from one analysis, so it can be collected or exported safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.operators import analyses, flows

SEGMENT_METRICS = ["avg_duration_min", "median_duration_min", "avg_distance_km", "round_trip_pct"]


def monthly_stack_from(monthly: DataFrame) -> DataFrame:
    """Stacked monthly bars from a ``monthly_volume`` result."""
    return monthly.select(
        "trip_month",
        "member_trips",
        "casual_trips",
        F.col("member_trips").alias("casual_bottom"),
        F.col("trips").alias("stack_top"),
    ).orderBy("trip_month")


def monthly_stack(trips: DataFrame) -> DataFrame:
    """Stacked monthly bars: member bar from 0, casual bar on top of it."""
    return monthly_stack_from(analyses.monthly_volume(trips))


def hourly_lines_from(hourly: DataFrame) -> DataFrame:
    return hourly.select("hour", "weekday_trips", "weekend_trips").orderBy("hour")


def hourly_lines(trips: DataFrame) -> DataFrame:
    """Weekday and weekend lines by hour, hour ascending."""
    return hourly_lines_from(analyses.hourly_demand(trips))


def season_bars_from(seasonal: DataFrame) -> DataFrame:
    label = F.concat(F.round("casual_pct", 0).cast("int").cast("string"), F.lit("% casual"))
    return seasonal.select("season", "trips", "casual_pct", label.alias("bar_label"))


def season_bars(trips: DataFrame) -> DataFrame:
    """Season bars with a ``'NN% casual'`` label (whole percent, half up)."""
    return season_bars_from(analyses.seasonal_demand(trips))


def segment_comparison_from(profile: DataFrame) -> DataFrame:
    """Long form ``metric, member, casual`` from a segment profile (any order).

    One row of conditional maxima, unfolded in the order of the metrics.
    """
    value = lambda segment, m: F.max(F.when(F.col("member_casual") == segment, F.col(m)))
    row = profile.agg(*(value(s, m).alias(f"{s}_{m}") for m in SEGMENT_METRICS for s in (schema.MEMBER, schema.CASUAL)))
    metrics = [
        F.struct(F.lit(m).alias("metric"), F.col(f"{schema.MEMBER}_{m}").alias(schema.MEMBER), F.col(f"{schema.CASUAL}_{m}").alias(schema.CASUAL))
        for m in SEGMENT_METRICS
    ]
    return row.select(F.inline(F.array(*metrics)))


def segment_comparison(trips: DataFrame) -> DataFrame:
    """Long form ``metric, member, casual`` of the four segment metrics."""
    return segment_comparison_from(analyses.segment_profile(trips))


def top_stations_chart_from_flow(flow: DataFrame, k: int = 15) -> DataFrame:
    top = flows.top_stations_from_flow(flow, k).select("station", "total_activity")
    return top.orderBy("total_activity", F.desc("station"))


def top_stations_chart(trips: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` busiest stations, smallest first (horizontal bar order)."""
    return top_stations_chart_from_flow(flows.station_flow(trips), k)


def imbalance_extremes_from(imbalance: DataFrame, k: int = 10) -> DataFrame:
    """``k`` strongest sources plus ``k`` strongest sinks of an imbalance table (any order).

    Each station stands once for either end; ``row_number() <= k`` per end is a
    group limit that every task applies before the shuffle, so the two tasks after
    it see ``k`` rows of each. A station can appear at both ends when fewer than
    ``2k`` stations qualify. ``direction`` is ``source`` when net outflow > 0.
    """
    net, top = F.col("net_outflow"), F.col("side") == "top"
    ends = imbalance.select("station", "net_outflow", F.explode(F.array(F.lit("top"), F.lit("bottom"))).alias("side"))
    order = [F.when(top, -net).otherwise(net), F.when(top, F.col("station")), F.when(~top, F.col("station")).desc()]
    rank = F.row_number().over(Window.partitionBy("side").orderBy(*order))
    first = ends.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
    direction = F.when(net > 0, "source").otherwise("sink")
    return first.select("station", "net_outflow", "side", direction.alias("direction")).orderBy("net_outflow", "station", "side")


def imbalance_extremes(trips: DataFrame, k: int = 10, min_activity: int = flows.DEFAULT_MIN_ACTIVITY) -> DataFrame:
    """``k`` strongest sources plus ``k`` strongest sinks of the imbalance table."""
    return imbalance_extremes_from(flows.net_outflow(flows.station_flow(trips), min_activity), k)
