"""Scalar Column functions: boundaries of every bucket and parse rule."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from dockflow.functions import (
    BBox,
    day_name,
    duration_min,
    grid_cell,
    haversine_km,
    is_weekend,
    month_key,
    normalise_category,
    normalise_name,
    parse_timestamp,
    route_label,
    season,
    time_of_day,
    weekday_order,
    within_bbox,
)


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_parse_timestamp_strict_and_truncating(spark):
    rows = [
        ("2024-01-12 08:15:00",),
        ("2024-01-13 23:50:10.403",),
        ("bad",),
        ("2024-13-45 00:00:00",),
        ("2024-1-5 01:02:03",),
        (None,),
        ("",),
    ]
    got = _one(spark, parse_timestamp("s"), rows, "s string")
    assert got == [
        dt.datetime(2024, 1, 12, 8, 15, 0),
        dt.datetime(2024, 1, 13, 23, 50, 10),
        None,
        None,
        None,
        None,
        None,
    ]


def test_parse_timestamp_is_wall_clock_in_dst_gap(spark):
    # 02:30 does not exist in America/New_York on 2024-03-10; NTZ keeps the text.
    got = _one(spark, parse_timestamp("s"), [("2024-03-10 02:30:00",)], "s string")
    assert got == [dt.datetime(2024, 3, 10, 2, 30, 0)]


def test_duration_whole_seconds_and_tz(spark):
    df = spark.createDataFrame(
        [("2024-10-06 05:59:59", "2024-10-06 06:01:00"), ("2024-11-03 00:30:00", "2024-11-03 03:30:00")],
        "a string, b string",
    ).select(parse_timestamp("a").alias("a"), parse_timestamp("b").alias("b"))
    wall = [r[0] for r in df.select(duration_min("a", "b")).collect()]
    assert wall[0] == pytest.approx(61 / 60.0)
    assert wall[1] == 180.0
    # Fall-back night: 3 wall-clock hours are 4 elapsed hours there.
    elapsed = [r[0] for r in df.select(duration_min("a", "b", tz="America/New_York")).collect()]
    assert elapsed[1] == 240.0


def test_season_boundaries(spark):
    rows = [(dt.datetime(2024, m, 15, 12, 0),) for m in range(1, 13)]
    got = _one(spark, season("t"), rows, "t timestamp_ntz")
    assert got == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer",
                   "Fall", "Fall", "Fall", "Winter"]


def test_time_of_day_boundaries(spark):
    rows = [(h,) for h in range(24)]
    got = _one(spark, time_of_day("h"), rows, "h int")
    expect = {h: "Overnight (0-5)" for h in range(0, 6)}
    expect.update({h: "Morning Peak (6-9)" for h in range(6, 10)})
    expect.update({h: "Midday (10-15)" for h in range(10, 16)})
    expect.update({h: "Evening Peak (16-19)" for h in range(16, 20)})
    expect.update({h: "Evening (20-23)" for h in range(20, 24)})
    assert got == [expect[h] for h in range(24)]


def test_weekend_day_name_and_order(spark):
    # 2024-01-08 is a Monday.
    rows = [(dt.datetime(2024, 1, 8 + i, 10, 0),) for i in range(7)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    out = df.select(day_name("t").alias("d"), is_weekend("t").alias("w")).select(
        "d", "w", weekday_order("d").alias("o")
    ).collect()
    assert [r.d for r in out] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert [r.w for r in out] == [False] * 5 + [True] * 2
    assert [r.o for r in out] == list(range(1, 8))


def test_month_key(spark):
    assert _one(spark, month_key("t"), [(dt.datetime(2024, 3, 1, 0, 0),)], "t timestamp_ntz") == ["2024-03"]


def test_haversine_known_values(spark):
    rows = [(41.90, -87.63, 41.91, -87.64), (41.90, -87.63, 41.90, -87.63), (0.0, 0.0, 0.0, 1.0)]
    got = _one(spark, haversine_km("a", "b", "c", "d"), rows, "a double, b double, c double, d double")
    assert round(got[0], 3) == 1.386
    assert got[1] == 0.0
    assert got[2] == pytest.approx(6371.0 * math.pi / 180.0)


def test_bbox_edges_inclusive(spark):
    box = BBox(41.60, 42.10, -87.95, -87.50)
    rows = [(41.60, -87.95), (42.10, -87.50), (41.59, -87.70), (41.80, -87.49), (None, -87.7)]
    got = _one(spark, within_bbox("lat", "lng", box), rows, "lat double, lng double")
    assert got == [True, True, False, False, None]


def test_grid_cell_floor(spark):
    got = _one(spark, grid_cell("x", 0.01), [(41.655,), (-87.655,)], "x double")
    assert got == [4165, -8766]


def test_text_normalisation(spark):
    df = spark.createDataFrame([(" Classic_Bike", " Alpha St ", "   ")], "a string, b string, c string")
    r = df.select(
        normalise_category("a").alias("a"),
        normalise_name("b").alias("b"),
        normalise_name("c").alias("c"),
        normalise_name("c", blank_as_null=True).alias("c2"),
        route_label(F.lit("X"), F.lit("Y")).alias("r"),
    ).first()
    assert (r.a, r.b, r.c, r.c2, r.r) == ("classic_bike", "Alpha St", "", None, "X -> Y")


def test_default_format_shape_check_equals_strict_parser(spark):
    """The fast default path accepts exactly what the strict formatter accepts."""
    texts = ["2024-01-12 08:15:00", "2024-02-30 00:00:00", "2024-02-29 00:00:00", "2023-02-29 00:00:00",
             "2024-13-01 00:00:00", "2024-01-01 24:00:00", "2024-01-01T08:15:00", " 2024-01-01 08:15:0",
             "2024-1-5 01:02:03", "bad", "", None, "2024-01-01 08:15:60", "+024-01-01 08:15:00",
             "2024-01-01 08:15:00.5", "2024-01-01 08:15", "2024/01/01 08:15:00", "9999-12-31 23:59:59",
             "2024-01-01 00:00:00Z", "2024-00-10 00:00:00", "2024-01-00 00:00:00", "2024-01-01 8:15:00 "]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    fast = parse_timestamp("s").cast("string")
    t = F.substring("s", 1, 19)
    reference = F.when(F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull(), t.try_cast("timestamp_ntz"))
    rows = df.select(fast.alias("a"), reference.cast("string").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_duration_does_not_depend_on_the_session_zone(spark):
    """A wall-clock gap across a daylight-saving change is the plain difference unless a zone is named."""
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 01:30:00' s, timestamp_ntz'2024-03-10 03:30:10' e, timestamp_ntz'2024-03-09 00:00:05' b")
    row = df.select(duration_min("s", "e").alias("x"), duration_min("e", "s").alias("y"), duration_min("b", "e").alias("z"),
                    duration_min("s", "e", "America/New_York").alias("t")).first()
    assert row.x == 7210 / 60 and row.y == -7210 / 60 and row.z == (86_400 + 3 * 3600 + 1805) / 60 and row.t == 3610 / 60
