"""Trip-shaped raw rows derived from an ``events`` table.

The test tables ship an event stream, not trips. One trip is one event and
the same user's next event; every rule below is deterministic so a SQL engine
can repeat it exactly (the oracle does). The derived rows deliberately
exercise the cleaning rules: ride ids in two differing copies, blanks-padded and
mixed-case categories, missing stations, NaN coordinates, a missing end time on
each user's last event, out-of-area coordinates, and per-trip GPS jitter. The
96 stations are of very uneven volume, and some see starts or ends only.

All derivation stays inside Spark: one JSON extraction, one skew-safe
successor lookup (:func:`dockflow.operators.sequence.with_next`), one explode
for the duplicates; the work grows linearly with the events table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.operators.sequence import with_next

# Fixed values of the derivation (shared with the SQL oracle).
SHIFT_DAYS_FACTOR = 2  # trip start = event time + (user_id * 2 % 360) days
SHIFT_DAYS_MODULO = 360
MISSING_STATION_FROM_K = 97  # k >= 97 -> no station name
# Station number (k*k + 40 * (event_id % 3)) div 97: 0 to 95, small ones much busier.
STATION_MODULO, STATION_SPREAD, STATION_DIVISOR = 3, 40, 97
END_ONLY, END_ONLY_SHIFT = (88, 89), 50  # a start there moves 50 down
START_ONLY_FROM, START_ONLY_SHIFT = 90, 60  # an end there moves 60 down
LAT_BASE, LAT_STEP, LAT_JITTER, JITTER_MODULO = 41.65, 0.004, 0.000137, 97
LNG_BASE, LNG_STEP, LNG_FACTOR, LNG_MODULO = -87.90, 0.003, 7, 97
CASUAL_USER_MODULO = 3
# Copies of a ride: event ids divisible by 50 come twice. The second copy starts
# 30 s earlier; of ids divisible by 100 it differs in its start latitude only;
# of ids divisible by 150 its end latitude is NaN.
DUPLICATE_EVERY, SAME_TIME_EVERY, BROKEN_COPY_EVERY = 50, 100, 150
COPY_EARLIER_S, COPY_LAT_SHIFT = 30, 0.001
NAN_EVERY = 211  # start latitude NaN


def _station(k: Column, event_id: Column) -> Column:
    return F.floor((k * k + STATION_SPREAD * (event_id % STATION_MODULO)) / STATION_DIVISOR).cast("int")


def _start(k: Column, event_id: Column) -> Column:
    s = _station(k, event_id)
    return F.when(s.isin(*END_ONLY), s - END_ONLY_SHIFT).otherwise(s)


def _end(k: Column, event_id: Column) -> Column:
    s = _station(k, event_id)
    return F.when(s >= START_ONLY_FROM, s - START_ONLY_SHIFT).otherwise(s)


def _name(k: Column, station: Column) -> Column:
    name = F.concat(F.lit("Station "), station.cast("string"))
    return F.when(k >= MISSING_STATION_FROM_K, F.lit(None).cast("string")).otherwise(name)


def _lat(station: Column) -> Column:
    return F.lit(LAT_BASE) + F.lit(LAT_STEP) * station


def _lng(station: Column) -> Column:
    return F.lit(LNG_BASE) + F.lit(LNG_STEP) * ((station * LNG_FACTOR) % LNG_MODULO)


def raw_trips_from_events(events: DataFrame, *, bucket_unit: str = "HOUR") -> DataFrame:
    """Return raw trips (``schema.RAW_SCHEMA`` columns) from an events DataFrame."""
    ev = events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    seq = with_next(ev, key="user_id", order=["ts", "event_id"], carry=["ts", "k"], bucket_unit=bucket_unit)

    shift = F.make_dt_interval(days=((F.col("user_id") * SHIFT_DAYS_FACTOR) % SHIFT_DAYS_MODULO).cast("int"))
    copies = F.when(F.col("event_id") % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    seq = seq.withColumn("copy", F.explode(copies))
    k, k2, eid, second = F.col("k"), F.col("k_next"), F.col("event_id"), F.col("copy") == 1
    start, end = _start(k, eid), _end(k2, eid)
    same_time = eid % SAME_TIME_EVERY == 0
    earlier = F.when(second & ~same_time, F.make_dt_interval(secs=F.lit(COPY_EARLIER_S).cast("decimal(18,6)"))).otherwise(F.make_dt_interval())
    lower = F.when(second & same_time, F.lit(COPY_LAT_SHIFT)).otherwise(F.lit(0.0))
    nan = F.lit(float("nan"))

    raw = seq.select(
        eid.cast("string").alias("ride_id"),
        F.when(F.col("event_type").isin("click", "view"), F.lit(" Classic_Bike"))
        .when(F.col("event_type") == "signup", F.lit("electric_scooter"))
        .otherwise(F.lit("electric_bike "))
        .alias("rideable_type"),
        (F.col("ts") + shift - earlier).cast("string").alias("started_at"),
        (F.col("ts_next") + shift).cast("string").alias("ended_at"),
        _name(k, start).alias("start_station_name"),
        F.lit(None).cast("string").alias("start_station_id"),
        _name(k2, end).alias("end_station_name"),
        F.lit(None).cast("string").alias("end_station_id"),
        F.when(eid % NAN_EVERY == 0, nan)
        .when(k == 0, F.lit(0.0))
        .otherwise(_lat(start) + F.lit(LAT_JITTER) * (eid % JITTER_MODULO) - lower)
        .alias("start_lat"),
        _lng(start).alias("start_lng"),
        F.when(second & (eid % BROKEN_COPY_EVERY == 0), nan).otherwise(_lat(end)).alias("end_lat"),
        _lng(end).alias("end_lng"),
        F.when(F.col("user_id") % CASUAL_USER_MODULO == 0, F.lit("casual "))
        .otherwise(F.lit("Member"))
        .alias("member_casual"),
    )
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in schema.RAW_SCHEMA.fields])
