"""Report metrics stated in the findings memo, as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.functions import BBox, SERVICE_AREA, grid_cell, mean_minutes, percent, ratio_half_up, whole_seconds, within_bbox
from dockflow.operators import analyses, flows
from dockflow.operators.clean import parse_raw
from dockflow.operators.quality import first_per_key
from dockflow.session import settled

SUMMER_MONTHS = (6, 7, 8)
WINTER_MONTHS = (12, 1, 2)


def demand_ratios_from_monthly(monthly: DataFrame) -> DataFrame:
    """Both ratios from ``trip_month, trips`` rows (at most a few hundred)."""
    month_no = F.substring("trip_month", 6, 2).cast("int")
    agg = monthly.agg(
        F.sum(F.when(month_no.isin(*SUMMER_MONTHS), F.col("trips")).otherwise(0)).alias("summer_trips"),
        F.sum(F.when(month_no.isin(*WINTER_MONTHS), F.col("trips")).otherwise(0)).alias("winter_trips"),
        F.min(F.struct((-F.col("trips")).alias("neg"), F.col("trip_month").alias("m"))).alias("_peak"),
        F.min(F.struct(F.col("trips").alias("n"), F.col("trip_month").alias("m"))).alias("_trough"),
    )
    return agg.select(
        "summer_trips",
        "winter_trips",
        ratio_half_up(F.col("summer_trips"), F.col("winter_trips"), 1).alias("summer_winter_ratio"),
        F.col("_peak.m").alias("peak_month"),
        (-F.col("_peak.neg")).alias("peak_trips"),
        F.col("_trough.m").alias("trough_month"),
        F.col("_trough.n").alias("trough_trips"),
        ratio_half_up(-F.col("_peak.neg"), F.col("_trough.n"), 1).alias("peak_trough_ratio"),
    )


def demand_ratios(trips: DataFrame) -> DataFrame:
    """Summer/winter trip ratio and peak/trough month ratio, in one row.

    Seasons are functions of the month, so both ratios come from the monthly
    counts (one aggregation over trips, then one over at most a few hundred
    month rows). Ties on trip counts pick the earlier month.
    """
    return demand_ratios_from_monthly(analyses.monthly_trips(trips))


def concentration_from_flow(flow: DataFrame, k: int = 15) -> DataFrame:
    """Share of all trip endpoints held by the ``k`` busiest stations of a flow.

    An ordered take for the busiest and a plain sum for all, brought together by
    one aggregation of their partial sums.
    """
    act = flow.select("station", (F.col("departures") + F.col("arrivals")).alias("activity"))
    none = F.lit(0).cast("long")
    busiest = act.orderBy(F.desc("activity"), "station").limit(k).select(F.col("activity").alias("top"), none.alias("activity"), none.alias("n"))
    everyone = act.select(none.alias("top"), "activity", F.lit(1).cast("long").alias("n"))
    agg = busiest.unionByName(everyone).agg(
        F.sum("top").alias("top_activity"),
        F.sum("activity").alias("total_activity"),
        F.coalesce(F.sum("n"), none).alias("stations"),
    )
    return agg.select(
        F.lit(k).alias("top_k"),
        "stations",
        "top_activity",
        "total_activity",
        percent(F.col("top_activity"), F.col("total_activity"), 1).alias("top_share_pct"),
    )


def station_concentration(trips: DataFrame, k: int = 15) -> DataFrame:
    """Share of all trip endpoints held by the ``k`` busiest stations.

    The station flow is written to the checkpoint folder when this is called:
    the result reads it twice, the trips once.
    """
    return concentration_from_flow(settled(flows.station_flow(trips), "station-flow"), k)


def _first(df: DataFrame, k: int | None) -> DataFrame:
    return df if k is None else df.limit(k)


def commuter_from_routes(routes: DataFrame, min_member_pct: float = 90.0, k: int | None = 25) -> DataFrame:
    """Routes of a route-statistics table whose member share exceeds ``min_member_pct``, busiest first.

    ``k`` keeps the busiest of those that qualify; ``None`` keeps all.
    """
    kept = routes.filter(F.col("member_pct") > F.lit(float(min_member_pct)))
    return _first(kept.orderBy(F.desc("trips"), "route", "start_station_name", "end_station_name"), k)


def commuter_routes(trips: DataFrame, min_member_pct: float = 90.0, k: int | None = 25) -> DataFrame:
    """Routes whose member share exceeds ``min_member_pct`` (see :func:`commuter_from_routes`)."""
    return commuter_from_routes(analyses.route_stats(trips), min_member_pct, k)


def summer_weekend_casual(trips: DataFrame, k: int | None = None) -> DataFrame:
    """Casual summer-weekend trips by start station, most first; ``k`` keeps the first only."""
    sel = trips.filter(
        (F.col("season") == "Summer") & F.col("is_weekend") & (F.col("member_casual") == schema.CASUAL)
    )
    per_station = sel.groupBy(F.col("start_station_name").alias("station")).agg(
        F.count(F.lit(1)).alias("trips"),
        mean_minutes(F.sum(whole_seconds(F.col("trip_duration_min"))), F.count("trip_duration_min")).alias("avg_duration_min"),
    )
    return _first(per_station.orderBy(F.desc("trips"), "station"), k)


def virtual_zones(raw: DataFrame, step_deg: float = 0.01, box: BBox = SERVICE_AREA, tz: str | None = None) -> DataFrame:
    """Demand of station-less trips on a ``step_deg`` GPS grid.

    Input is the raw zone (the curated zone has no station-less trips). Rows
    need a ride id, a parsed start time and start coordinates inside the box;
    ride ids are de-duplicated the same way as in cleaning.
    """
    parsed = parse_raw(raw, tz=tz)
    dockless = parsed.filter(
        F.col("start_station_name").isNull()
        & F.col("ride_id").isNotNull()
        & F.col("started_at").isNotNull()
        & within_bbox("start_lat", "start_lng", box)
    ).select("ride_id", "started_at", "start_lat", "start_lng", "member_casual")
    unique = first_per_key(dockless, "ride_id", ["started_at"])
    casual = F.lower(F.trim("member_casual")) == schema.CASUAL
    return (
        unique.groupBy(grid_cell("start_lat", step_deg).alias("zone_lat"), grid_cell("start_lng", step_deg).alias("zone_lng"))
        .agg(F.count(F.lit(1)).alias("trips"), F.count_if(casual).alias("casual_trips"))
        .orderBy(F.desc("trips"), "zone_lat", "zone_lng")
    )
