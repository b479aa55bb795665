"""Zones, publishing, quarantine, the observed funnel, month tables and sketches."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.operators.clean import clean_and_count, clean_trips, quality_funnel
from dockflow.operators.quality import Rule, default_rules
from dockflow.plans import sketches
from dockflow.plans.catalog import load_statements, run_sql_files
from dockflow.sources import zone
from dockflow.sources.curated import month_files, publish_changes, read_trips, write_trips
from dockflow.sources.raw_csv import read_raw_with_quarantine

from .conftest import MINI_CSV, ROOT


def _rows(df):
    return sorted((tuple(r) for r in df.select(*schema.CURATED_COLUMNS).collect()), key=str)


# The funnel, observed

def test_observed_funnel_and_trips(spark, mini_raw, tmp_dir):
    trips, funnel = clean_and_count(mini_raw.repartition(5), os.path.join(tmp_dir, "a"))
    assert _rows(trips) == _rows(clean_trips(mini_raw))
    assert funnel.collect() == quality_funnel(mini_raw).collect() and funnel.dtypes == quality_funnel(mini_raw).dtypes
    short = [*default_rules(), Rule("member", F.col("member_casual") == "member")]
    trips, funnel = clean_and_count(mini_raw, os.path.join(tmp_dir, "b"), rules=short)
    assert _rows(trips) == _rows(clean_trips(mini_raw, rules=short))
    assert funnel.collect() == quality_funnel(mini_raw, rules=short).collect()
    trips, funnel = clean_and_count(mini_raw.limit(0), os.path.join(tmp_dir, "c"))
    assert trips.count() == 0 and [r.rows for r in funnel.collect()] == [0] * 5


def test_the_observation_is_in_the_tasks_that_write(spark, mini_raw, tmp_dir, monkeypatch):
    """Nothing is shuffled behind it, and raw is read once."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans = []
    real = DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return real(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    clean_and_count(mini_raw, os.path.join(tmp_dir, "a"))
    (plan,) = plans
    assert plan.count("FileScan csv") == 1 and plan.count("Exchange") == 1
    assert plan.index("CollectMetrics") < plan.index("Exchange")  # the plan's root comes first


def test_failed_attempts_are_not_counted(tmp_dir):
    """Every first attempt of a task fails behind the observation, after it has passed its rows."""
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        from dockflow.operators import clean
        from dockflow.operators.quality import Rule
        from dockflow.sources.raw_csv import read_raw_trips
        raw = read_raw_trips(spark, {MINI_CSV!r})
        real = clean.derive_columns
        def fails_once(df):
            out = real(df)
            def run(batches):
                held = list(batches)
                if TaskContext.get().attemptNumber() == 0:
                    raise RuntimeError("first attempt")
                yield from held
            return out.mapInArrow(run, out.schema)
        clean.derive_columns = fails_once
        trips, funnel = clean.clean_and_count(raw, {os.path.join(tmp_dir, "out")!r})
        print("FUNNEL", trips.count(), [r.rows for r in funnel.orderBy("step_no").collect()])
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_dir)
    assert "FUNNEL 6 [13, 10, 9, 7, 6]" in out.stdout, out.stderr[-2000:]


# Malformed lines

def test_quarantine(spark, tmp_dir):
    lines = [x for x in open(MINI_CSV).read().splitlines() if ",xx," not in x]  # one has text for a number already
    good = lines[1]
    cells = good.split(",")
    bad = {
        ",".join(cells[:-1]): "too few fields",
        good + ",more": "too many fields",
        good + ",": "too many fields",
        ",".join([*cells[:8], "north", *cells[9:]]): "not a number: start_lat",
        ",".join([*cells[:9], "1e", "x", *cells[11:]]): "not a number: start_lng",
        "lonely": "too few fields",
    }
    empty_number = ",".join([*cells[:8], "", *cells[9:]])
    quoted = ",".join([cells[0], cells[1], cells[2], cells[3], '"A, B"', *cells[5:]])
    with open(os.path.join(tmp_dir, "202401-a.csv"), "w") as fh:
        fh.write("\n".join([*lines, *bad, "", empty_number, quoted]) + "\n")
    ok, refused = read_raw_with_quarantine(spark, tmp_dir)
    assert {(r.line, r.reason) for r in refused.collect()} == set(bad.items())
    assert {r.file.rsplit("/", 1)[1] for r in refused.select("file").collect()} == {"202401-a.csv"}
    assert ok.count() == len(lines) - 1 + 2 and refused.count() == len(bad)  # no column in use
    assert ok.where("start_station_name = 'A, B'").count() == 1 and ok.columns == schema.RAW_COLUMNS
    text = ok._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text


# Zones

def test_months_are_replaced_at_once(spark, mini_raw, tmp_dir, monkeypatch):
    path, trips = os.path.join(tmp_dir, "zone"), clean_trips(mini_raw)
    months = sorted(r[0] for r in trips.select("trip_month").distinct().collect())
    zone.replace_months(trips, path, months, write_trips)
    assert _rows(read_trips(spark, path)) == _rows(trips)
    one = trips.where(F.col("trip_month") == months[0]).limit(1)
    with monkeypatch.context() as m:
        def dies(*_):
            raise OSError("power cut")

        m.setattr(zone, "commit", dies)
        with pytest.raises(OSError):
            zone.replace_months(one, path, months[:1], write_trips)
    assert _rows(read_trips(spark, path)) == _rows(trips)  # the old month, whole
    reader = read_trips(spark, path)
    zone.replace_months(one, path, months[:1], write_trips)
    assert read_trips(spark, path, months=months[:1]).count() == 1  # the new month
    assert _rows(read_trips(spark, path, months=months[1:])) == _rows(trips.where(F.col("trip_month") != months[0]))
    assert _rows(reader) == _rows(trips)  # who began earlier can finish
    zone.replace_months(trips.limit(0), path, months[:1], write_trips)
    assert read_trips(spark, path, months=months[:1]).count() == 0
    assert len(zone.expired_folders(spark, path)) == 3  # replaced twice, and what the writer that died had written


def _times(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_publish_copies_what_changed(spark, mini_raw, tmp_dir):
    source, target, trips = os.path.join(tmp_dir, "source"), os.path.join(tmp_dir, "target"), clean_trips(mini_raw)
    months = sorted(r[0] for r in trips.select("trip_month").distinct().collect())
    write_trips(trips.where(F.col("trip_month") != months[-1]), source)
    actions = lambda **o: {r.trip_month: r.action for r in publish_changes(spark, source, target, **o).collect()}
    assert actions() == dict.fromkeys(months[:-1], "new")
    was = _times(target)
    manifest = zone.read_manifest(spark, target)
    assert set(actions().values()) == {"same"} and _times(target) == was and zone.read_manifest(spark, target) == manifest
    write_trips(trips.where(F.col("trip_month").isin(months[0], months[-1])), source, dynamic_overwrite=True)
    assert actions() == {m: {months[0]: "changed", months[-1]: "new"}.get(m, "same") for m in months}
    now = _times(target)
    assert {k: now[k] for k in was} == was  # not rewritten: new files beside the old
    assert _rows(read_trips(spark, target)) == _rows(trips)
    write_trips(trips.where(F.col("trip_month") != months[1]), source)
    assert actions()[months[1]] == "kept"
    assert _rows(read_trips(spark, target)) == _rows(trips)
    assert actions()[months[1]] == "kept"
    assert actions(remove=True)[months[1]] == "removed"
    assert _rows(read_trips(spark, target)) == _rows(trips.where(F.col("trip_month") != months[1]))


def test_publish_a_zone_with_a_manifest(spark, mini_raw, tmp_dir):
    source, target, trips = os.path.join(tmp_dir, "source"), os.path.join(tmp_dir, "target"), clean_trips(mini_raw)
    months = sorted(r[0] for r in trips.select("trip_month").distinct().collect())
    zone.replace_months(trips, source, months, write_trips)
    publish_changes(spark, source, target)
    zone.replace_months(trips.limit(0), source, months[:1], write_trips)
    done = {r.trip_month: r.action for r in publish_changes(spark, source, target, remove=True).collect()}
    assert done == {m: "removed" if m == months[0] else "same" for m in months}
    assert _rows(read_trips(spark, target)) == _rows(read_trips(spark, source))
    assert month_files(spark, source).select("trip_month").distinct().count() == len(months) - 1


def test_a_table_of_months_prunes_at_run_time(spark, trips_medium, tmp_dir):
    path = os.path.join(tmp_dir, "trips")
    write_trips(trips_medium, path)
    table = os.path.join(tmp_dir, "months")
    spark.createDataFrame([("2024-02", 1), ("2024-03", 0), ("2024-05", 1)], "trip_month string, wanted int").write.parquet(table)
    months = spark.read.parquet(table).where("wanted = 1")
    df = read_trips(spark, path, months=months).select("ride_id", "trip_month")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    want = trips_medium.where(F.col("trip_month").isin("2024-02", "2024-05")).select("ride_id", "trip_month")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
    zoned = os.path.join(tmp_dir, "zone")
    zone.replace_months(trips_medium, zoned, [f"2024-{m:02d}" for m in range(1, 13)], write_trips)
    df = read_trips(spark, zoned, months=months).select("ride_id", "trip_month")
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString().lower()
    assert df.count() == want.count()


# Statements and sketches

def test_statements_with_parameters_from_any_path(spark, trips_small, tmp_dir):
    with open(os.path.join(tmp_dir, "2 busy hours.sql"), "w") as fh:
        fh.write("SELECT hour, COUNT(*) AS trips FROM trips GROUP BY hour\nHAVING COUNT(*) >= :least ORDER BY hour;\n")
    with open(os.path.join(tmp_dir, "1.sql"), "w") as fh:
        fh.write("SELECT COUNT(*) AS n FROM trips")
    spark.createDataFrame([("SELECT 1 AS one\n;",)], "value string").coalesce(1).write.text(os.path.join(tmp_dir, "3.sql"))
    for where in (tmp_dir, f"file://{tmp_dir}"):
        assert list(load_statements(spark, where)) == ["1", "2 busy hours", "3"]
        out = run_sql_files(spark, trips_small, where, params={"least": 20})
        assert out["1"].first().n == trips_small.count() and out["3"].first().one == 1
        want = trips_small.groupBy("hour").count().where("count >= 20").orderBy("hour").collect()
        assert [tuple(r) for r in out["2 busy hours"].collect()] == [tuple(r) for r in want] and want
    assert list(load_statements(spark, os.path.join(tmp_dir, "1.sql"))) == ["1"]


def test_medians_of_merged_sketches(spark, trips_medium):
    monthly = sketches.duration_sketches(trips_medium).cache()
    assert monthly.count() == trips_medium.select("trip_month", "member_casual").distinct().count()
    for months in (None, ["2024-01"], ["2024-02", "2024-03", "2024-07"]):
        rows = trips_medium if months is None else trips_medium.where(F.col("trip_month").isin(months))
        durations: dict[str, list[float]] = {}
        for r in rows.select("member_casual", "trip_duration_min").collect():
            durations.setdefault(r[0], []).append(r[1])
        found = {r.member_casual: r for r in sketches.merged_medians(monthly, months).collect()}
        assert {k: len(v) for k, v in durations.items()} == {k: r.trips for k, r in found.items()}
        for k, v in durations.items():
            est, slack = found[k].median_duration_min, sketches.rank_error() * len(v) + 1
            assert sum(x < est for x in v) <= len(v) / 2 + slack and sum(x <= est for x in v) >= len(v) / 2 - slack
