"""Shared-scan report equals the one-query-per-analysis results."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from dockflow.plans.catalog import CORE_ANALYSES, run_catalog
from dockflow.plans.rollup import CORE_QUERIES, CUBE_KEYS, REPORT_QUERIES, run_report, trip_cube


def test_core_report_matches_direct_queries(trips_medium):
    report = run_report(trips_medium, min_activity=50)
    direct = run_catalog(trips_medium, params={"station_imbalance": {"min_activity": 50}})
    assert list(report) == CORE_ANALYSES == CORE_QUERIES
    for name in CORE_ANALYSES:
        a, b = report[name], direct[name]
        assert a.columns == b.columns, name
        assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()], name


def test_full_report_matches_every_direct_query(trips_medium):
    report = run_report(trips_medium, REPORT_QUERIES, entry.PARAMS)
    direct = run_catalog(trips_medium, REPORT_QUERIES, entry.PARAMS)
    for name in REPORT_QUERIES:
        a, b = report[name], direct[name]
        assert a.columns == b.columns, name
        assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()], name


def test_unknown_report_query(trips_small):
    with pytest.raises(KeyError):
        run_report(trips_small, ["station_imbalance_by_join"])


def test_cube_is_small_and_complete(trips_medium):
    cube = trip_cube(trips_medium)
    n_cells = cube.count()
    assert n_cells <= trips_medium.count()
    months = trips_medium.select("trip_month").distinct().count()
    assert n_cells <= months * 3 * 2 * 7 * 24
    assert cube.groupBy().sum("trips").first()[0] == trips_medium.count()
    assert set(CUBE_KEYS) <= set(cube.columns)


def test_report_reads_trips_once(spark, trips_small, tmp_path):
    from dockflow.plans.rollup import report_summary
    from dockflow.sources.curated import read_trips, write_trips

    path = str(tmp_path / "t")
    write_trips(trips_small, path)
    plan = report_summary(read_trips(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Expand" in plan and "partial_" in plan
