"""Exact means: ties round one way whatever the partitioning; NaN counts as missing."""

from __future__ import annotations

import math
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.functions import ratio_half_up
from dockflow.operators.analyses import top_routes
from dockflow.operators.clean import clean_trips, quality_funnel
from dockflow.operators.quality import drop_missing, required_present
from dockflow.plans.rollup import run_report

# 13 distances of a route that add up to 354.445 km: the mean 27.265 lies on a rounding boundary.
DISTANCES = [27.265, 10.1, 44.43, 0.001, 54.529, 27.264, 27.266, 30.03, 24.5, 20.2, 34.33, 26.265, 28.265]


@pytest.fixture(scope="module")
def tied(spark, trips_small):
    assert sum(round(d * 1000) for d in DISTANCES) == 354_445
    first = trips_small.limit(1)
    rows = spark.createDataFrame([(d, 10.0 + k) for k, d in enumerate(DISTANCES)], "trip_distance_km double, trip_duration_min double")
    return first.drop("trip_distance_km", "trip_duration_min").crossJoin(rows).select(*first.columns)


@pytest.mark.parametrize("parts", [1, 3, 8, 16])
def test_a_tie_rounds_up_in_any_partitioning(tied, parts):
    trips = tied.repartition(parts)
    direct = top_routes(trips).first()
    report = run_report(trips, ["top_routes"])["top_routes"].first()
    assert direct.avg_distance_km == 27.27 and tuple(direct) == tuple(report)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(0, 10**6), st.integers(0, 3)), min_size=1, max_size=30))
def test_ratio_half_up_is_exact(spark, rows):
    df = spark.createDataFrame([(i, n, d, s) for i, (n, d, s) in enumerate(rows)], "i int, n long, d long, s int")
    for scale in {s for _, _, s in rows}:
        for r in df.where(F.col("s") == scale).select("n", "d", ratio_half_up(F.col("n"), F.col("d"), scale).alias("x")).collect():
            if not r.d:
                assert r.x is None
                continue
            units = math.floor(abs(Fraction(r.n, r.d)) * 10**scale + Fraction(1, 2))
            assert r.x == (-units if r.n < 0 else units) / 10**scale


def test_nan_counts_as_missing(spark, mini_raw):
    good = mini_raw.where("ride_id = 'A1'")
    bad = good.withColumn("end_lat", F.lit(float("nan"))).withColumn("started_at", F.lit("2024-01-12 08:00:00"))
    raw = good.unionByName(bad)
    assert drop_missing(raw).count() == raw.filter(required_present()).count() == 1
    kept = clean_trips(raw).collect()
    assert [r.ride_id for r in kept] == ["A1"] and kept[0].end_lat == 41.91
    assert [r.rows for r in quality_funnel(raw).collect()] == [2, 1, 1, 1, 1]


def test_the_funnel_shuffles_what_it_needs(mini_raw):
    plan = quality_funnel(mini_raw)._jdf.queryExecution().executedPlan().toString()
    winner = plan[plan.rindex("THEN struct("):]
    winner = winner[: winner.index(" END")]
    assert "start_lat" in winner and "trip_duration_min" in winner
    for column in ("station", "rideable_type", "member_casual"):
        assert column not in winner


def test_custom_rules_without_columns_see_the_same_winner(mini_raw):
    from dockflow.operators.quality import Rule

    rules = [Rule("members", F.col("member_casual") == schema.MEMBER)]
    funnel = [r.rows for r in quality_funnel(mini_raw, rules=rules).collect()]
    assert funnel[-1] == clean_trips(mini_raw, rules=rules).count()
