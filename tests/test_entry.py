"""Driver contract: entry runs, every query has an oracle, oracle agrees at sf0.001."""

from __future__ import annotations

import math
import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

from .conftest import SF_MEDIUM, SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["trip_month", "trips", "member_trips", "casual_trips", "avg_duration_min"]
    assert len(rows) == 2 and sum(r.trips for r in rows) == entry.queries()["clean_trips"](spark, SF_SMALL).count()


def test_every_query_has_an_oracle():
    own = {q for q in entry.queries() if not re.match(r"op\d+_|pipeline$", q)}
    assert own == {q for q in entry.oracle_sql() if q in own} and len(own) == 40


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in sorted(os.listdir(SF_SMALL)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, f)}')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle_agrees_small(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL).toPandas()
    odf = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    cols = sorted(sdf.columns)

    def rows(df):
        out = []
        for r in df[cols].itertuples(index=False, name=None):
            out.append(tuple(None if (isinstance(x, float) and math.isnan(x)) else _norm(getattr(x, "item", lambda: x)()) for x in r))
        return sorted(out, key=repr)

    assert rows(sdf) == rows(odf)


SPARK_TO_SQL_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                     "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def test_oracle_column_types_align(spark, duck):
    for name in entry.oracle_sql():
        fn = entry.queries()[name]
        spark_types = {f.name: SPARK_TO_SQL_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in fn(spark, SF_SMALL).schema.fields}
        rel = duck.sql(entry.oracle_sql()[name])
        assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}, name


# Queries whose rows come in a stated order that the oracle states too.
ORDERED = [
    "monthly_volume", "usage_by_bike_type", "member_vs_casual", "member_vs_casual_approx", "trip_patterns_by_dow", "hourly_demand",
    "time_of_day_demand", "top_routes", "top_stations", "station_imbalance", "seasonal_demand", "monthly_trips",
    "top_draining_stations", "station_imbalance_by_join", "draining_by_join", "monthly_stack", "hourly_lines", "season_bars",
    "top_stations_chart", "intraday_imbalance", "rebalancing_pairs", "commuter_routes", "summer_weekend_casual", "quality_funnel",
    "virtual_zones",
]


@pytest.fixture(scope="module")
def duck_medium():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{os.path.join(SF_MEDIUM, 'events.parquet')}')")
    return con


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_the_oracle_order(spark, duck_medium, name):
    df = entry.queries()[name](spark, SF_MEDIUM)
    rows = [tuple(_norm(x) for x in r) for r in df.collect()]
    rel = duck_medium.sql(entry.oracle_sql()[name])
    want = [tuple(_norm(r[rel.columns.index(c)]) for c in df.columns) for r in rel.fetchall()]
    assert rows == want


def test_dayparts_come_in_the_order_of_the_day(spark):
    parts = [r.time_of_day for r in entry.queries()["time_of_day_demand"](spark, SF_MEDIUM).collect()]
    assert list(dict.fromkeys(parts)) == [
        "Overnight (0-5)", "Morning Peak (6-9)", "Midday (10-15)", "Evening Peak (16-19)", "Evening (20-23)"]


@pytest.mark.parametrize("name, at_most", [
    ("top_routes", 25), ("top_stations", 25), ("top_stations_chart", 15), ("imbalance_extremes", 20), ("commuter_routes", 25), ("top_draining_stations", 5)])
def test_limits_cut(spark, trips_medium, name, at_most):
    """The fixture has more stations and routes than any limit, and thresholds that remove some."""
    rows = entry.queries()[name](spark, SF_MEDIUM).count()
    stations = trips_medium.select("start_station_name").distinct().count()
    assert rows == at_most < stations


def test_thresholds_and_joins_bite(spark, trips_medium):
    from dockflow.operators import flows

    flow = flows.station_flow(trips_medium)
    one_sided = flow.where("departures = 0 or arrivals = 0").count()
    kept = entry.queries()["station_imbalance"](spark, SF_MEDIUM).count()
    assert one_sided > 0 and 0 < kept < flow.count()
    assert entry.queries()["station_concentration"](spark, SF_MEDIUM).first().top_share_pct < 100


@pytest.mark.parametrize("change", [
    ("ORDER BY started_at, ended_at, start_lat", "ORDER BY started_at DESC, ended_at, start_lat"),
    ("ORDER BY started_at, ended_at, start_lat", "ORDER BY started_at, ended_at, start_lat DESC"),
    ("AND NOT isnan(start_lat) AND NOT isnan(start_lng) AND NOT isnan(end_lat) AND NOT isnan(end_lng)", ""),
])
def test_a_wrong_winner_shows(spark, duck_medium, change):
    sql = entry.oracle_sql()["clean_trips"]
    assert change[0] in sql
    right = duck_medium.sql(f"SELECT COUNT(*), SUM(hash(ride_id, started_at, start_lat) % 1000003) FROM ({sql})").fetchall()
    wrong = duck_medium.sql(f"SELECT COUNT(*), SUM(hash(ride_id, started_at, start_lat) % 1000003) FROM ({sql.replace(*change)})").fetchall()
    assert right != wrong
