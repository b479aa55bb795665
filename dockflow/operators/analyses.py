"""Single-aggregation analyses over curated trips.

Each is one ``groupBy`` on low-cardinality keys (month, category, hour, ...):
Spark aggregates partially on the map side, so the shuffle carries one row per
task and group no matter how many trips a group holds. Shares of the grand
total use a window over the already-aggregated rows, whose count is bounded by
the category domain. Outputs are ordered; ties always fall back to the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.functions import mean_km, mean_minutes, percent, route_label, weekday_order, whole_metres, whole_seconds


def _avg_duration() -> Column:
    d = F.col("trip_duration_min")
    return mean_minutes(F.sum(whole_seconds(d)), F.count(d)).alias("avg_duration_min")


def _avg_distance() -> Column:
    d = F.col("trip_distance_km")
    return mean_km(F.sum(whole_metres(d)), F.count(d)).alias("avg_distance_km")


def _pct_of_rows(cond: Column, scale: int) -> Column:
    """Percentage of the group's rows where ``cond`` holds."""
    return percent(F.count_if(cond), F.count(F.lit(1)), scale)


def _is(col: str, value) -> Column:
    return F.col(col) == F.lit(value)


def _share_of_total(count_col: str, scale: int = 2) -> Column:
    whole = Window.partitionBy()
    return percent(F.col(count_col), F.sum(count_col).over(whole), scale)


def monthly_volume(trips: DataFrame) -> DataFrame:
    """Trips per month split by rider segment, with the mean duration."""
    return (
        trips.groupBy("trip_month")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.count_if(_is("member_casual", schema.MEMBER)).alias("member_trips"),
            F.count_if(_is("member_casual", schema.CASUAL)).alias("casual_trips"),
            _avg_duration(),
        )
        .orderBy("trip_month")
    )


def usage_by_bike_type(trips: DataFrame) -> DataFrame:
    """Vehicle type x segment: trips, share of all trips, mean duration and distance."""
    agg = trips.groupBy("rideable_type", "member_casual").agg(
        F.count(F.lit(1)).alias("trips"),
        _avg_duration(),
        _avg_distance(),
    )
    return agg.select(
        "rideable_type",
        "member_casual",
        "trips",
        _share_of_total("trips").alias("pct_of_all_trips"),
        "avg_duration_min",
        "avg_distance_km",
    ).orderBy(F.desc("trips"), "rideable_type", "member_casual")


def lower_median(df: DataFrame, keys: list[str], value: str, alias: str = "median") -> DataFrame:
    """Exact lower median of ``value`` per ``keys``: the smallest value whose
    cumulative count reaches half the group (``percentile_approx`` definition,
    SQL ``quantile_disc(0.5)``).

    Counts per (keys, value) are aggregated partially before the shuffle, so
    the work after it is bounded by the number of distinct values per group,
    not by rows. Trip durations are whole seconds inside the cleaning window,
    so a group has at most 86,339 distinct values however many trips it holds.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select(
        *keys,
        value,
        F.sum("_n").over(upto).alias("_cum"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    return ranked.filter(F.col("_cum") * 2 >= F.col("_total")).groupBy(*keys).agg(F.min(value).alias(alias))


def segment_profile(trips: DataFrame, median_accuracy: int | None = None) -> DataFrame:
    """Segment profile without an order: counts, exact means, median, round-trip rate.

    One aggregation per (segment, duration) -- at most 86,339 durations per
    segment, whatever the number of trips -- holds everything: its counts and
    integer sums add up to the segment's, and its running count gives the lower
    median. One large shuffle; the window and the second aggregation see that
    bounded table only. ``median_accuracy`` takes ``percentile_approx`` instead,
    for durations without a small discrete domain.
    """
    metres, n = F.col("trip_distance_km"), F.count(F.lit(1))
    if median_accuracy is not None:
        approx = F.percentile_approx("trip_duration_min", 0.5, median_accuracy)
        return trips.groupBy("member_casual").agg(
            n.alias("trips"), _avg_duration(), F.round(approx, 2).alias("median_duration_min"), _avg_distance(),
            _pct_of_rows(F.col("is_round_trip"), 2).alias("round_trip_pct"),
        )
    per_value = trips.groupBy("member_casual", "trip_duration_min").agg(
        n.alias("n"), F.sum(whole_metres(metres)).alias("metres"), F.count(metres).alias("n_metres"),
        F.count_if(F.col("is_round_trip")).alias("round_trips"),
    )
    return profile_from_durations(per_value)


def profile_from_durations(per_value: DataFrame) -> DataFrame:
    """:func:`segment_profile` from ``member_casual, trip_duration_min, n, metres, n_metres, round_trips``."""
    value = F.col("trip_duration_min")
    whole = Window.partitionBy("member_casual")
    upto = whole.orderBy(value.asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.when(value.isNotNull(), F.col("n")).otherwise(0)
    ranked = per_value.select("*", F.sum(known).over(upto).alias("_cum"), F.sum(known).over(whole).alias("_total"))
    median = F.min(F.when(F.col("_cum") * 2 >= F.col("_total"), value))
    return ranked.groupBy("member_casual").agg(
        F.sum("n").alias("trips"),
        mean_minutes(F.sum(whole_seconds(value) * F.col("n")), F.sum(known)).alias("avg_duration_min"),
        F.round(median, 2).alias("median_duration_min"),
        mean_km(F.sum("metres"), F.sum("n_metres")).alias("avg_distance_km"),
        percent(F.sum("round_trips"), F.sum("n"), 2).alias("round_trip_pct"),
    )


def ordered_profile(profile: DataFrame) -> DataFrame:
    """A segment profile with each segment's share of all trips, largest first."""
    return profile.select(
        "member_casual",
        "trips",
        _share_of_total("trips").alias("pct_share"),
        "avg_duration_min",
        "median_duration_min",
        "avg_distance_km",
        "round_trip_pct",
    ).orderBy(F.desc("trips"), "member_casual")


def member_vs_casual(trips: DataFrame, median_accuracy: int | None = None) -> DataFrame:
    """Segment profile: share, mean and median duration, distance, round-trip rate (see :func:`segment_profile`)."""
    return ordered_profile(segment_profile(trips, median_accuracy))


def trip_patterns_by_dow(trips: DataFrame) -> DataFrame:
    """Per weekday: trips, mean duration and distance; Monday first."""
    return (
        trips.groupBy("day_of_week", "is_weekend")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            _avg_duration(),
            _avg_distance(),
        )
        .orderBy(weekday_order("day_of_week"), "day_of_week", "is_weekend")
    )


def hourly_demand(trips: DataFrame) -> DataFrame:
    """Trips per start hour, weekday vs weekend."""
    return (
        trips.groupBy("hour")
        .agg(
            F.count_if(~F.col("is_weekend")).alias("weekday_trips"),
            F.count_if(F.col("is_weekend")).alias("weekend_trips"),
            F.count(F.lit(1)).alias("total_trips"),
        )
        .orderBy("hour")
    )


def time_of_day_demand(trips: DataFrame) -> DataFrame:
    """Daypart x segment: trips and mean duration, in daypart order."""
    return (
        trips.groupBy("time_of_day", "member_casual")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            _avg_duration(),
            F.min("hour").alias("_first_hour"),
        )
        .orderBy("_first_hour", "member_casual", "time_of_day")
        .drop("_first_hour")
    )


def route_stats(trips: DataFrame) -> DataFrame:
    """Every directed station pair with its trip count and member share.

    Grouped on the two station names only; the ``route`` label is a function
    of them and is rebuilt after the aggregation, keeping it out of the
    shuffle key.
    """
    agg = trips.groupBy("start_station_name", "end_station_name").agg(
        F.count(F.lit(1)).alias("trips"),
        _avg_duration(),
        _avg_distance(),
        _pct_of_rows(_is("member_casual", schema.MEMBER), 1).alias("member_pct"),
    )
    return agg.select(
        route_label("start_station_name", "end_station_name").alias("route"),
        "start_station_name",
        "end_station_name",
        "trips",
        "avg_duration_min",
        "avg_distance_km",
        "member_pct",
    )


def top_routes(trips: DataFrame, k: int = 25) -> DataFrame:
    """The ``k`` busiest directed routes (top-k: one ordered take, no full sort)."""
    return route_stats(trips).orderBy(F.desc("trips"), "route", "start_station_name", "end_station_name").limit(k)


def seasonal_demand(trips: DataFrame) -> DataFrame:
    """Per season: trips, mean duration and distance, casual share; in calendar order."""
    return (
        trips.groupBy("season")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            _avg_duration(),
            _avg_distance(),
            _pct_of_rows(_is("member_casual", schema.CASUAL), 1).alias("casual_pct"),
            F.min(F.month("started_at")).alias("_first_month"),
        )
        .orderBy("_first_month", "season")
        .drop("_first_month")
    )


def monthly_trips(trips: DataFrame) -> DataFrame:
    """Trips per month; on partitioned Parquet this reads no data column at all."""
    return trips.groupBy("trip_month").agg(F.count(F.lit(1)).alias("trips")).orderBy("trip_month")
