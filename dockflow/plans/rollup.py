"""Shared-scan report: the whole trips catalog from ONE aggregation of the trips.

Running the analyses one by one scans the curated trips once per query. Here
a single ``GROUPING SETS`` aggregation (one scan, rows expanded per set and
partially aggregated before one shuffle) produces five summaries at once:

* the *trip cube* keyed by (month, vehicle type, segment, weekday, hour) --
  plus ``is_weekend``, ``time_of_day`` and ``season``, functions of those keys
  that add no rows -- with counts and sums: at most months x 3 x 2 x 7 x 24
  cells (about 12k per year) however many trips there are. Monthly, vehicle,
  segment, weekday, hourly, daypart and seasonal results re-aggregate it;
* route statistics per (start, end) station pair: top routes, and the station
  flow (departures = sum over routes leaving, arrivals = over routes arriving);
* counts per (segment, duration): the exact median (bounded by the number of
  distinct whole-second durations);
* counts per (start station, daypart, season, weekend, segment): departures
  by daypart and the summer-weekend casual demand;
* counts per (end station, end daypart): arrivals by daypart.

Every summary is bounded by category domains and the number of stations (or
station pairs), never by the number of trips.

The combined summary is written once as Parquet partitioned by its grouping set
under ``spark.checkpoint.dir`` (lineage cut, survives executor loss); each report
query reads the parts it needs only.

Sums are whole seconds and metres, so means and shares equal the direct
queries' exactly (see ``functions.exact``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow import schema

from dockflow.functions import (
    mean_km,
    mean_minutes,
    percent,
    route_label,
    time_of_day,
    weekday_order,
    whole_metres,
    whole_seconds,
)
from dockflow.operators import analyses, flows
from dockflow.plans import feeds, report
from dockflow.session import scratch_path

CUBE_KEYS = ["trip_month", "rideable_type", "member_casual", "day_of_week", "is_weekend", "hour", "time_of_day", "season"]
ROUTE_KEYS = ["start_station_name", "end_station_name"]
MEDIAN_KEYS = ["member_casual", "trip_duration_min"]
DEPARTURE_KEYS = ["start_station_name", "time_of_day", "season", "is_weekend", "member_casual"]
ARRIVAL_KEYS = ["end_station_name", "end_time_of_day"]
SETS = [CUBE_KEYS, ROUTE_KEYS, MEDIAN_KEYS, DEPARTURE_KEYS, ARRIVAL_KEYS]
SUMMARY_KEYS = list(dict.fromkeys(k for keys in SETS for k in keys))
MEASURES = ["trips", "seconds", "n_seconds", "metres", "n_metres", "round_trips", "member_trips", "first_month"]


def _grouping_id(grouped: list[str]) -> int:
    """``grouping_id()`` value of a set: bit set for every key NOT grouped."""
    n = len(SUMMARY_KEYS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(SUMMARY_KEYS) if c not in grouped)


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("trips"),
        F.sum(whole_seconds(F.col("trip_duration_min"))).alias("seconds"),
        F.count("trip_duration_min").alias("n_seconds"),
        F.sum(whole_metres(F.col("trip_distance_km"))).alias("metres"),
        F.count("trip_distance_km").alias("n_metres"),
        F.count_if(F.col("is_round_trip")).alias("round_trips"),
        F.count_if(F.col("member_casual") == schema.MEMBER).alias("member_trips"),
        F.min(F.month("started_at")).alias("first_month"),
    ]


def report_summary(trips: DataFrame) -> DataFrame:
    """The five summaries in one aggregation, tagged by ``gid``."""
    with_end = trips.withColumn("end_time_of_day", time_of_day(F.hour("ended_at")))
    return with_end.groupingSets(SETS, *SUMMARY_KEYS).agg(*_measures(), F.grouping_id().alias("gid"))


def summary_part(summary: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of one grouping set, with its keys and the measures."""
    return summary.filter(F.col("gid") == _grouping_id(keys)).select(*keys, *MEASURES)


def split_summary(summary: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cube, route counts, duration counts) out of :func:`report_summary`."""
    cube = summary_part(summary, CUBE_KEYS)
    routes = summary_part(summary, ROUTE_KEYS)
    durations = summary_part(summary, MEDIAN_KEYS)
    return cube, routes, durations


def trip_cube(trips: DataFrame) -> DataFrame:
    """Counts and sums per cube cell alone (partial aggregation before the shuffle)."""
    return trips.groupBy(*CUBE_KEYS).agg(*_measures())


def _n() -> Column:
    return F.sum("trips")


def _mean_duration() -> Column:
    return mean_minutes(F.sum("seconds"), F.sum("n_seconds")).alias("avg_duration_min")


def _mean_distance() -> Column:
    return mean_km(F.sum("metres"), F.sum("n_metres")).alias("avg_distance_km")


def _trips_where(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("trips")).otherwise(0))


def _pct_where(cond: Column, scale: int) -> Column:
    return percent(_trips_where(cond), F.sum("trips"), scale)


def _share(scale: int = 2) -> Column:
    return percent(F.col("trips"), F.sum("trips").over(Window.partitionBy()), scale)


def monthly_volume(cube: DataFrame) -> DataFrame:
    return (
        cube.groupBy("trip_month")
        .agg(
            _n().alias("trips"),
            _trips_where(F.col("member_casual") == schema.MEMBER).alias("member_trips"),
            _trips_where(F.col("member_casual") == schema.CASUAL).alias("casual_trips"),
            _mean_duration(),
        )
        .orderBy("trip_month")
    )


def usage_by_bike_type(cube: DataFrame) -> DataFrame:
    agg = cube.groupBy("rideable_type", "member_casual").agg(
        _n().alias("trips"), _mean_duration(), _mean_distance()
    )
    return agg.select(
        "rideable_type", "member_casual", "trips", _share().alias("pct_of_all_trips"), "avg_duration_min", "avg_distance_km"
    ).orderBy(F.desc("trips"), "rideable_type", "member_casual")


def segment_profile(durations: DataFrame) -> DataFrame:
    """Segment profile (``analyses.segment_profile``) from the (segment, duration) summary."""
    return analyses.profile_from_durations(durations.withColumnRenamed("trips", "n"))


def member_vs_casual(durations: DataFrame) -> DataFrame:
    return analyses.ordered_profile(segment_profile(durations))


def trip_patterns_by_dow(cube: DataFrame) -> DataFrame:
    return (
        cube.groupBy("day_of_week", "is_weekend")
        .agg(_n().alias("trips"), _mean_duration(), _mean_distance())
        .orderBy(weekday_order("day_of_week"), "day_of_week", "is_weekend")
    )


def hourly_demand(cube: DataFrame) -> DataFrame:
    return (
        cube.groupBy("hour")
        .agg(
            _trips_where(~F.col("is_weekend")).alias("weekday_trips"),
            _trips_where(F.col("is_weekend")).alias("weekend_trips"),
            _n().alias("total_trips"),
        )
        .orderBy("hour")
    )


def time_of_day_demand(cube: DataFrame) -> DataFrame:
    return (
        cube.groupBy("time_of_day", "member_casual")
        .agg(_n().alias("trips"), _mean_duration(), F.min("hour").alias("_first_hour"))
        .orderBy("_first_hour", "member_casual", "time_of_day")
        .drop("_first_hour")
    )


def seasonal_demand(cube: DataFrame) -> DataFrame:
    return (
        cube.groupBy("season")
        .agg(
            _n().alias("trips"),
            _mean_duration(),
            _mean_distance(),
            _pct_where(F.col("member_casual") == schema.CASUAL, 1).alias("casual_pct"),
            F.min("first_month").alias("_first_month"),
        )
        .orderBy("_first_month", "season")
        .drop("_first_month")
    )


def route_stats(routes: DataFrame) -> DataFrame:
    """Route statistics (same columns as ``analyses.route_stats``) from route counts."""
    return routes.select(
        route_label("start_station_name", "end_station_name").alias("route"),
        "start_station_name",
        "end_station_name",
        "trips",
        mean_minutes(F.col("seconds"), F.col("n_seconds")).alias("avg_duration_min"),
        mean_km(F.col("metres"), F.col("n_metres")).alias("avg_distance_km"),
        percent(F.col("member_trips"), F.col("trips"), 1).alias("member_pct"),
    )


def station_flow(routes: DataFrame) -> DataFrame:
    """``station, departures, arrivals`` from route counts (one row per station pair)."""
    ends = routes.select(
        F.inline(
            F.array(
                F.struct(F.col("start_station_name").alias("station"), F.col("trips").alias("departures"), F.lit(0).cast("long").alias("arrivals")),
                F.struct(F.col("end_station_name").alias("station"), F.lit(0).cast("long").alias("departures"), F.col("trips").alias("arrivals")),
            )
        )
    )
    return ends.groupBy("station").agg(F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals"))


def monthly_trips(cube: DataFrame) -> DataFrame:
    return cube.groupBy("trip_month").agg(_n().alias("trips")).orderBy("trip_month")


def intraday_counts(departures: DataFrame, arrivals: DataFrame) -> DataFrame:
    """``station, time_of_day, departures, arrivals`` rows from the two daypart summaries."""
    dep = departures.select(
        F.col("start_station_name").alias("station"), "time_of_day",
        F.col("trips").alias("departures"), F.lit(0).cast("long").alias("arrivals"),
    )
    arr = arrivals.select(
        F.col("end_station_name").alias("station"), F.col("end_time_of_day").alias("time_of_day"),
        F.lit(0).cast("long").alias("departures"), F.col("trips").alias("arrivals"),
    )
    return dep.unionByName(arr)


def summer_weekend_casual(departures: DataFrame, k: int | None = None) -> DataFrame:
    sel = departures.filter(
        (F.col("season") == "Summer") & F.col("is_weekend") & (F.col("member_casual") == schema.CASUAL)
    )
    per_station = sel.groupBy(F.col("start_station_name").alias("station")).agg(_n().alias("trips"), _mean_duration())
    ordered = per_station.orderBy(F.desc("trips"), "station")
    return ordered if k is None else ordered.limit(k)


# Queries the report produces; the literal join forms are left to the catalog.
REPORT_QUERIES = [
    "monthly_volume", "usage_by_bike_type", "member_vs_casual", "trip_patterns_by_dow", "hourly_demand",
    "time_of_day_demand", "top_routes", "top_stations", "station_imbalance", "seasonal_demand",
    "monthly_trips", "top_draining_stations", "monthly_stack", "hourly_lines", "season_bars",
    "segment_comparison", "top_stations_chart", "imbalance_extremes", "demand_ratios",
    "station_concentration", "intraday_imbalance", "rebalancing_pairs", "commuter_routes",
    "summer_weekend_casual",
]
CORE_QUERIES = REPORT_QUERIES[:10]


def run_report(
    trips: DataFrame,
    names: Iterable[str] | None = None,
    params: Mapping[str, Mapping[str, object]] | None = None,
    *,
    min_activity: int | None = None,
) -> dict[str, DataFrame]:
    """Report queries (default: the ten core analyses) from one aggregation of ``trips``.

    ``params`` holds per-query keyword parameters, as for
    ``plans.catalog.run_catalog``; ``min_activity`` sets the station threshold
    of every station query at once. The summary is written eagerly (one job: one
    scan, one shuffle); the returned results are lazy queries over it.
    """
    selected = list(names) if names is not None else list(CORE_QUERIES)
    unknown = [n for n in selected if n not in REPORT_QUERIES]
    if unknown or not selected:
        raise KeyError(f"not report queries: {unknown or selected}")
    params = {k: dict(v) for k, v in (params or {}).items()}

    def p(name: str, key: str, default):
        if key == "min_activity" and min_activity is not None and key not in params.get(name, {}):
            return min_activity
        return params.get(name, {}).get(key, default)

    spark, path = trips.sparkSession, scratch_path(trips.sparkSession, "report-summary")
    report_summary(trips).write.partitionBy("gid").parquet(path)
    summary = spark.read.parquet(path)
    cube, routes, durations = split_summary(summary)
    departures, arrivals = summary_part(summary, DEPARTURE_KEYS), summary_part(summary, ARRIVAL_KEYS)
    flow = station_flow(routes)
    route_table = route_stats(routes)
    dflt = flows.DEFAULT_MIN_ACTIVITY

    def imbalance(name: str) -> DataFrame:
        return flows.net_outflow(flow, p(name, "min_activity", dflt))

    builders = {
        "monthly_volume": lambda: monthly_volume(cube),
        "usage_by_bike_type": lambda: usage_by_bike_type(cube),
        "member_vs_casual": lambda: member_vs_casual(durations),
        "trip_patterns_by_dow": lambda: trip_patterns_by_dow(cube),
        "hourly_demand": lambda: hourly_demand(cube),
        "time_of_day_demand": lambda: time_of_day_demand(cube),
        "top_routes": lambda: route_table.orderBy(F.desc("trips"), "route", "start_station_name", "end_station_name")
        .limit(p("top_routes", "k", 25)),
        "top_stations": lambda: flows.top_stations_from_flow(flow, p("top_stations", "k", 25)),
        "station_imbalance": lambda: flows.imbalance_from_flow(flow, p("station_imbalance", "min_activity", dflt)),
        "seasonal_demand": lambda: seasonal_demand(cube),
        "monthly_trips": lambda: monthly_trips(cube),
        "top_draining_stations": lambda: flows.draining_from_flow(
            flow, p("top_draining_stations", "min_activity", dflt), p("top_draining_stations", "k", 5)
        ),
        "monthly_stack": lambda: feeds.monthly_stack_from(monthly_volume(cube)),
        "hourly_lines": lambda: feeds.hourly_lines_from(hourly_demand(cube)),
        "season_bars": lambda: feeds.season_bars_from(seasonal_demand(cube)),
        "segment_comparison": lambda: feeds.segment_comparison_from(segment_profile(durations)),
        "top_stations_chart": lambda: feeds.top_stations_chart_from_flow(flow, p("top_stations_chart", "k", 15)),
        "imbalance_extremes": lambda: feeds.imbalance_extremes_from(
            imbalance("imbalance_extremes"), p("imbalance_extremes", "k", 10)
        ),
        "demand_ratios": lambda: report.demand_ratios_from_monthly(monthly_trips(cube)),
        "station_concentration": lambda: report.concentration_from_flow(flow, p("station_concentration", "k", 15)),
        "intraday_imbalance": lambda: flows.intraday_from_counts(
            intraday_counts(departures, arrivals), p("intraday_imbalance", "min_activity", 0)
        ),
        "rebalancing_pairs": lambda: flows.pairs_from_imbalance(imbalance("rebalancing_pairs")),
        "commuter_routes": lambda: report.commuter_from_routes(
            route_table, p("commuter_routes", "min_member_pct", 90.0), p("commuter_routes", "k", 25)
        ),
        "summer_weekend_casual": lambda: summer_weekend_casual(departures, p("summer_weekend_casual", "k", None)),
    }
    return {name: builders[name]() for name in selected}
