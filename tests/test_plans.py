"""Physical-plan checks: pruning, pushdown, single scan, no Python in analyses."""

from __future__ import annotations

import re

import pytest

from dockflow.operators import analyses, flows
from dockflow.plans.catalog import CORE_ANALYSES, run_catalog
from dockflow.sources.curated import read_trips, write_trips


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def curated(spark, trips_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated") / "trips")
    write_trips(trips_small, path)
    return path


def test_monthly_trips_reads_no_data_column(spark, curated):
    plan = _formatted(analyses.monthly_trips(read_trips(spark, curated)))
    assert "ReadSchema: struct<>" in plan


def test_month_filter_prunes_partitions(spark, curated):
    df = read_trips(spark, curated, months=["2024-01"])
    plan = _formatted(analyses.monthly_volume(df))
    assert "PartitionFilters: [isnotnull(trip_month" in plan and "2024-01" in plan
    assert {r.trip_month for r in analyses.monthly_trips(df).collect()} <= {"2024-01"}


def test_column_pruning_on_curated(spark, curated):
    plan = _formatted(analyses.hourly_demand(read_trips(spark, curated)))
    schema = re.search(r"ReadSchema: (struct<[^\n]*>)", plan).group(1)
    assert schema == "struct<hour:int,is_weekend:boolean>"


def test_station_flow_single_scan(spark, curated):
    plan = _formatted(flows.station_imbalance(read_trips(spark, curated), 50))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, flags=re.M)) == 1
    assert "Generate" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_aggregations_are_partial(spark, curated):
    for name, df in run_catalog(read_trips(spark, curated)).items():
        plan = _plan(df)
        assert "partial_" in plan, name


def test_no_python_in_analysis_plans(spark, curated):
    for name in CORE_ANALYSES:
        df = run_catalog(read_trips(spark, curated), [name])[name]
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_top_k_is_take_ordered(spark, curated):
    plan = _plan(analyses.top_routes(read_trips(spark, curated)))
    assert "TakeOrderedAndProject" in plan


def test_pushed_filter_reaches_scan(spark, curated):
    df = read_trips(spark, curated).filter("member_casual = 'casual'")
    plan = _formatted(analyses.hourly_demand(df))
    assert "PushedFilters: [IsNotNull(member_casual), EqualTo(member_casual,casual)]" in plan


def test_curated_layout(spark, curated):
    import os

    months = sorted(d for d in os.listdir(curated) if d.startswith("trip_month="))
    assert months and all(re.fullmatch(r"trip_month=\d{4}-\d{2}", m) for m in months)
    back = read_trips(spark, curated)
    assert dict(back.dtypes)["trip_month"] == "string"
    assert back.count() == spark.read.parquet(curated).count()


def test_write_splits_a_hot_month(spark, trips_medium, tmp_path):
    """A month holding most rows is written by several tasks, not one."""
    import glob as _glob

    from pyspark.sql import functions as F

    hot = trips_medium.withColumn(
        "trip_month", F.when(F.hash("ride_id") % 5 != 0, F.lit("2024-06")).otherwise(F.col("trip_month"))
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64KB")
    try:
        path = str(tmp_path / "hot")
        write_trips(hot, path)
    finally:
        spark.conf.set(key, old)
    files = _glob.glob(f"{path}/trip_month=2024-06/*.parquet")
    assert len(files) > 1
    assert read_trips(spark, path).count() == trips_medium.count()

def _exchanges(plan: str) -> int:
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count("Exchange SinglePartition")


def test_no_task_ranks_all_stations(spark, curated):
    """Extremes, concentration and pairs: a limit before the shuffle, no window over all stations, no sort below a window."""
    from dockflow.plans import feeds, report

    trips = read_trips(spark, curated)
    extremes = _plan(feeds.imbalance_extremes(trips, min_activity=1))
    assert extremes.count("WindowGroupLimit") == 2 and extremes.count("FileScan") == 1 and "SinglePartition" not in extremes
    assert "rangepartitioning" not in extremes[extremes.index("WindowGroupLimit"):]
    concentration = _plan(report.station_concentration(trips))
    assert "Window" not in concentration and "TakeOrderedAndProject" in concentration
    pairs = _plan(flows.rebalancing_pairs(trips, min_activity=1))
    assert _exchanges(pairs) <= 4
    assert "Exchange SinglePartition" not in pairs


def test_segment_profile_has_one_large_shuffle(spark, curated):
    from dockflow.plans import feeds

    trips = read_trips(spark, curated)
    plan = _plan(analyses.member_vs_casual(trips))
    assert "Expand" not in plan
    comparison = _plan(feeds.segment_comparison(trips))
    assert _exchanges(comparison) <= 4 and "rangepartitioning" not in comparison and "Expand" not in comparison


def test_report_queries_read_their_part_of_the_summary(spark, trips_small):
    from dockflow.plans.rollup import REPORT_QUERIES, run_report

    for name, df in run_report(trips_small, [q for q in REPORT_QUERIES if q != "rebalancing_pairs"], min_activity=1).items():
        plan = _plan(df)
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        assert scans and all("PartitionFilters: [isnotnull(gid" in line for line in scans), name
