"""Schemas and fixed domain values of the trip data model.

The raw zone holds monthly CSV files with the 13 columns of ``RAW_SCHEMA``
(timestamps as text, parsed by the cleaning step). The curated zone holds the
cleaned trips as Parquet partitioned by ``trip_month`` with the extra derived
columns listed in ``CURATED_COLUMNS``.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the source pipeline's definitions for
# results to match: column names and types, timestamp text format, required fields, the duration
# window in minutes (both ends exclusive), the service-area bounding box
# (inclusive), the earth radius used for distances, season months and the
# daypart hour ranges with their labels.
# ---------------------------------------------------------------------------
RAW_SCHEMA = StructType(
    [
        StructField("ride_id", StringType()),
        StructField("rideable_type", StringType()),
        StructField("started_at", StringType()),
        StructField("ended_at", StringType()),
        StructField("start_station_name", StringType()),
        StructField("start_station_id", StringType()),
        StructField("end_station_name", StringType()),
        StructField("end_station_id", StringType()),
        StructField("start_lat", DoubleType()),
        StructField("start_lng", DoubleType()),
        StructField("end_lat", DoubleType()),
        StructField("end_lng", DoubleType()),
        StructField("member_casual", StringType()),
    ]
)

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

DERIVED_COLUMNS = [
    "trip_duration_min",
    "trip_date",
    "trip_month",
    "trip_year",
    "hour",
    "day_of_week",
    "is_weekend",
    "season",
    "time_of_day",
    "trip_distance_km",
    "route",
    "is_round_trip",
]

CURATED_COLUMNS = RAW_COLUMNS + DERIVED_COLUMNS

PARTITION_COLUMN = "trip_month"

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
TS_TEXT_LENGTH = 19

REQUIRED_COLUMNS = [
    "ride_id",
    "started_at",
    "ended_at",
    "start_station_name",
    "end_station_name",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
    "rideable_type",
]

MIN_DURATION_MIN = 1.0
MAX_DURATION_MIN = 1440.0

LAT_MIN, LAT_MAX = 41.60, 42.10
LNG_MIN, LNG_MAX = -87.95, -87.50

EARTH_RADIUS_KM = 6371.0

SEASON_MONTHS = [
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
]
SEASON_OTHERWISE = "Fall"

DAYPARTS = [
    ("Morning Peak (6-9)", 6, 9),
    ("Midday (10-15)", 10, 15),
    ("Evening Peak (16-19)", 16, 19),
    ("Evening (20-23)", 20, 23),
]
DAYPART_OTHERWISE = "Overnight (0-5)"

WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

ROUTE_SEPARATOR = " -> "

MEMBER = "member"
CASUAL = "casual"
