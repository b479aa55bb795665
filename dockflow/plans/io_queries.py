"""Registered queries of sources, sinks and landing: trips go through files and come back.

Each takes the session and an ``events`` table, derives raw trips from all of it
(:mod:`dockflow.sources.fixture`), writes them under the checkpoint folder in the
form the feature reads, and returns what the feature makes of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.functions import duration_min, parse_timestamp
from dockflow.operators.clean import clean_and_count, clean_trips
from dockflow.plans import catalog, sketches
from dockflow.session import scratch_path, settled
from dockflow.sources.archives import read_archived_trips, write_archived_trips
from dockflow.sources.curated import publish_changes, read_trips, write_trips
from dockflow.sources.fixture import raw_trips_from_events
from dockflow.sources.raw_csv import read_raw_with_quarantine, write_raw_trips
from dockflow.streaming.landing import land_trips, run_to_completion

# Fixed values, repeated in the oracle's SQL.
DELIVERIES = 3
DELIVERY_ORDER = (2, 0, 1)
SHORT_EVERY, LONG_EVERY, TEXT_EVERY = 61, 67, 71  # lines that lose a field, get one more, have text for a number
SELECTED_FROM, SELECTED_MIN_TRIPS = "2024-03", 20
MIN_ACTIVITY = 150
ZONE = "America/Chicago"
SPRING_NIGHT, AUTUMN_NIGHT = "2024-03-10 00:30:00", "2024-11-03 00:10:00"


def landed_trips(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Raw files arrive in three deliveries, latest rides first; copies of a ride come in different ones. The zone at the end."""
    base = scratch_path(spark, "landed-trips")
    raw = raw_trips_from_events(events)
    delivery = F.pmod(F.xxhash64("ride_id", "started_at", "start_lat", "end_lat"), F.lit(DELIVERIES))
    for k in DELIVERY_ORDER:
        write_raw_trips(raw.where(delivery == k), f"{base}/raw/delivery-{k}")
        run_to_completion(land_trips(spark, f"{base}/raw", f"{base}/zone", f"{base}/checkpoint"))
    return read_trips(spark, f"{base}/zone")


def archived_trips(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Raw trips written as ZIP archives, read from them and cleaned."""
    path = scratch_path(spark, "archived-trips")
    write_archived_trips(raw_trips_from_events(events), path)
    return clean_trips(read_archived_trips(spark, path, check_header=True).select(*schema.RAW_COLUMNS))


def observed_funnel(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The quality funnel counted while the trips are written."""
    return clean_and_count(raw_trips_from_events(events), scratch_path(spark, "observed-trips"))[1]


def _damaged_lines(raw: DataFrame) -> DataFrame:
    """Raw trips as CSV lines, some of them malformed."""
    ride = F.col("ride_id").cast("long")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schema.RAW_COLUMNS]
    at = schema.RAW_COLUMNS.index("end_lat")
    text = [*fields[:at], F.when(ride % TEXT_EVERY == 0, F.lit("north")).otherwise(fields[at]), *fields[at + 1:]]
    line = F.concat_ws(",", *text)
    line = F.when(ride % SHORT_EVERY == 0, F.concat_ws(",", *text[:-1])).when(ride % LONG_EVERY == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    return raw.select(line.alias("line"))


def _damaged_files(spark: SparkSession, events: DataFrame) -> str:
    path = scratch_path(spark, "damaged-raw")
    _damaged_lines(raw_trips_from_events(events)).write.text(path)
    return path


def quarantined_rows(spark: SparkSession, events: DataFrame) -> DataFrame:
    """``(ride_id, reason)`` of the malformed lines of raw files, a row each."""
    _, bad = read_raw_with_quarantine(spark, _damaged_files(spark, events), header=False, glob_filter="*.txt")
    return bad.select("ride_id", "reason")


def accepted_trips(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Trips cleaned from the good lines of the same files."""
    good, _ = read_raw_with_quarantine(spark, _damaged_files(spark, events), header=False, glob_filter="*.txt")
    return clean_trips(good)


def published_months(spark: SparkSession, events: DataFrame) -> DataFrame:
    """A zone published, changed and published again: ``(trip_month, trips, action)`` of the second time.

    At first the last month is missing; then it comes and the first month loses its
    casual rides. ``trips``: what the target holds in the end.
    """
    base = scratch_path(spark, "published")
    trips = settled(clean_trips(raw_trips_from_events(events)), "published-trips")
    month = F.col("trip_month")
    ends = trips.agg(F.min("trip_month"), F.max("trip_month")).first()
    write_trips(trips.where(month < ends[1]), f"{base}/source")
    publish_changes(spark, f"{base}/source", f"{base}/target")
    edited = trips.where(((month == ends[0]) & (F.col("member_casual") == "member")) | (month == ends[1]))
    write_trips(edited, f"{base}/source", dynamic_overwrite=True)
    done = publish_changes(spark, f"{base}/source", f"{base}/target")
    counts = read_trips(spark, f"{base}/target").groupBy("trip_month").agg(F.count(F.lit(1)).alias("trips"))
    return done.join(counts, "trip_month", "left").select("trip_month", F.coalesce("trips", F.lit(0).cast("long")).alias("trips"), "action")


def selected_months(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Trips and member trips of the months that a table selects; only their folders are read."""
    base = scratch_path(spark, "selected-months")
    write_trips(clean_trips(raw_trips_from_events(events)), f"{base}/zone")
    counts = read_trips(spark, f"{base}/zone").groupBy("trip_month").agg(F.count(F.lit(1)).alias("n"))
    counts.write.parquet(f"{base}/months")
    wanted = spark.read.schema("trip_month string, n long").parquet(f"{base}/months").where((F.col("trip_month") >= SELECTED_FROM) & (F.col("n") >= SELECTED_MIN_TRIPS))
    trips = read_trips(spark, f"{base}/zone", months=wanted)
    return trips.groupBy("trip_month").agg(F.count(F.lit(1)).alias("trips"), F.count_if(F.col("member_casual") == "member").alias("member_trips"))


STATEMENT = """
SELECT station, departures, arrivals, departures - arrivals AS net_outflow,
  CAST(ROUND(100 * (departures - arrivals) / CAST(departures + arrivals AS DECIMAL(18, 0)), 1) AS DOUBLE) AS net_outflow_pct
FROM (
  SELECT station, SUM(departure) AS departures, SUM(1 - departure) AS arrivals
  FROM (SELECT STACK(2, start_station_name, 1, end_station_name, 0) AS (station, departure) FROM trips)
  GROUP BY station
)
WHERE departures + arrivals >= :min_activity
ORDER BY net_outflow DESC, station;
"""


def sql_station_imbalance(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Station imbalance as a statement of a SQL catalog, its threshold a named parameter."""
    base = scratch_path(spark, "sql-catalog")
    spark.createDataFrame([(STATEMENT,)], "value string").coalesce(1).write.text(f"{base}/station_imbalance.sql")
    trips = clean_trips(raw_trips_from_events(events))
    return catalog.run_sql_files(spark, trips, base, params={"min_activity": MIN_ACTIVITY, "unused": 0})["station_imbalance"]


def median_from_sketches(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Per segment the trips, and whether the median of merged monthly sketches is within the stated rank error."""
    trips = settled(clean_trips(raw_trips_from_events(events)), "sketched-trips")
    monthly = settled(sketches.duration_sketches(trips), "duration-sketches")
    found = sketches.merged_medians(monthly).select("member_casual", F.col("trips").alias("_n"), "median_duration_min")
    below = trips.join(F.broadcast(found), "member_casual").groupBy("member_casual").agg(  # two segments
        F.max("_n").alias("trips"), F.count_if(F.col("trip_duration_min") < F.col("median_duration_min")).alias("less"),
        F.count_if(F.col("trip_duration_min") <= F.col("median_duration_min")).alias("up_to"))
    slack = sketches.rank_error() * F.col("trips")
    return below.select("member_casual", "trips", ((F.col("less") <= F.col("trips") / 2 + slack) & (F.col("up_to") >= F.col("trips") / 2 - slack)).alias("within_rank_error"))


def zoned_durations(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Rides across both clock changes of a year: elapsed minutes in the zone, beside the wall clock's."""
    eid = F.col("event_id")
    wall = lambda night: F.lit(night).cast("timestamp_ntz") + F.make_dt_interval(secs=((eid * 37) % 12_600).cast("decimal(18,6)"))
    night = F.explode(F.array(F.struct(F.lit("spring").alias("night"), wall(SPRING_NIGHT).alias("start")), F.struct(F.lit("autumn").alias("night"), wall(AUTUMN_NIGHT).alias("start"))))
    rides = events.select(eid.cast("string").alias("ride_id"), eid, night.alias("n"))
    length = F.make_dt_interval(secs=(60 + (eid * 53) % 9_000).cast("decimal(18,6)"))
    texts = rides.select("ride_id", "n.night", F.col("n.start").cast("string").alias("started_at"), (F.col("n.start") + length).cast("string").alias("ended_at"))
    start, end = parse_timestamp("started_at"), parse_timestamp("ended_at")
    parsed = texts.select("ride_id", "night", start.alias("started_at"), end.alias("ended_at"))
    return parsed.select("ride_id", "night", "started_at", "ended_at", duration_min("started_at", "ended_at", tz=ZONE).alias("elapsed_min"), duration_min("started_at", "ended_at").alias("wall_min"))


IO_QUERIES: dict[str, Callable[[SparkSession, DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (
        landed_trips, archived_trips, observed_funnel, quarantined_rows, accepted_trips, published_months, selected_months,
        sql_station_imbalance, median_from_sketches, zoned_durations,
    )
}
