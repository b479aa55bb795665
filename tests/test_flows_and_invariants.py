"""Station flow forms agree; cross-query invariants hold (totals, shares, signs)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dockflow.operators import analyses, flows
from dockflow.plans import feeds, report


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_explode_and_join_imbalance_agree(trips_medium):
    for t in (0, 50, 5000):
        assert _rows(flows.station_imbalance(trips_medium, t)) == _rows(flows.station_imbalance_by_join(trips_medium, t))


def test_draining_forms_agree(trips_medium):
    assert _rows(flows.top_draining_stations(trips_medium, 50)) == _rows(flows.draining_by_join(trips_medium, 50))


def test_one_sided_station_full_outer_vs_inner(spark):
    """A station with departures only is kept by the full-outer form, not the inner one."""
    trips = spark.createDataFrame(
        [("A", "B"), ("A", "B"), ("B", "C")], "start_station_name string, end_station_name string"
    )
    full = {r.station: r.net_outflow for r in flows.station_imbalance(trips, 0).collect()}
    assert full == {"A": 2, "B": -1, "C": -1}
    inner = {r.station for r in flows.top_draining_stations(trips, 0, k=10).collect()}
    assert inner == {"B"}
    assert {r.station for r in flows.draining_by_join(trips, 0, k=10).collect()} == inner


def test_trip_totals_agree_across_queries(trips_medium):
    n = trips_medium.count()
    sums = {
        "monthly": analyses.monthly_volume(trips_medium).agg(F.sum("trips")).first()[0],
        "bike": analyses.usage_by_bike_type(trips_medium).agg(F.sum("trips")).first()[0],
        "segment": analyses.member_vs_casual(trips_medium).agg(F.sum("trips")).first()[0],
        "dow": analyses.trip_patterns_by_dow(trips_medium).agg(F.sum("trips")).first()[0],
        "hour": analyses.hourly_demand(trips_medium).agg(F.sum("total_trips")).first()[0],
        "daypart": analyses.time_of_day_demand(trips_medium).agg(F.sum("trips")).first()[0],
        "season": analyses.seasonal_demand(trips_medium).agg(F.sum("trips")).first()[0],
        "lake": analyses.monthly_trips(trips_medium).agg(F.sum("trips")).first()[0],
    }
    assert set(sums.values()) == {n}


def test_weekday_plus_weekend_is_total(trips_medium):
    for r in analyses.hourly_demand(trips_medium).collect():
        assert r.weekday_trips + r.weekend_trips == r.total_trips


def test_shares_sum_to_100(trips_medium):
    for df, col in ((analyses.usage_by_bike_type(trips_medium), "pct_of_all_trips"),
                    (analyses.member_vs_casual(trips_medium), "pct_share")):
        assert df.agg(F.sum(col)).first()[0] == pytest.approx(100.0, abs=0.05)


def test_net_outflow_sums_to_zero_and_activity_is_twice_trips(trips_medium):
    n = trips_medium.count()
    flow = flows.station_flow(trips_medium)
    agg = flow.agg(F.sum(F.col("departures") - F.col("arrivals")), F.sum(F.col("departures") + F.col("arrivals"))).first()
    assert agg[0] == 0 and agg[1] == 2 * n
    top_all = flows.top_stations(trips_medium, k=10_000).agg(F.sum("total_activity")).first()[0]
    assert top_all == 2 * n


def test_top_k_ordering_and_ties(trips_medium):
    top = flows.top_stations(trips_medium, 3).collect()
    assert len(top) == 3
    keys = [(-r.total_activity, r.station) for r in top]
    assert keys == sorted(keys)
    routes = analyses.top_routes(trips_medium, 25).collect()
    assert len(routes) == 25
    assert all(routes[i].trips >= routes[i + 1].trips for i in range(24))


def test_month_order_and_season_order(trips_medium):
    months = [r.trip_month for r in analyses.monthly_volume(trips_medium).collect()]
    assert months == sorted(months)
    seasons = [r.season for r in analyses.seasonal_demand(trips_medium).collect()]
    assert seasons == ["Winter", "Spring", "Summer", "Fall"]
    dows = [r.day_of_week for r in analyses.trip_patterns_by_dow(trips_medium).collect()]
    assert dows == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_intraday_imbalance_sums_to_station_totals(trips_medium):
    intra = flows.intraday_imbalance(trips_medium).groupBy("station").agg(
        F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals")
    )
    assert _rows(intra) == _rows(flows.station_flow(trips_medium))


def test_rebalancing_pairs_rank_match(trips_medium):
    pairs = flows.rebalancing_pairs(trips_medium, 50).collect()
    imb = flows.station_imbalance(trips_medium, 50).collect()
    n_sinks = sum(1 for r in imb if r.net_outflow < 0)
    n_sources = sum(1 for r in imb if r.net_outflow > 0)
    assert len(pairs) == min(n_sinks, n_sources)
    for p in pairs:
        assert p.bikes_to_move == min(p.from_surplus, p.to_deficit) and p.bikes_to_move > 0


def test_feeds_shapes(trips_medium):
    seg = feeds.segment_comparison(trips_medium).collect()
    assert [r.metric for r in seg] == feeds.SEGMENT_METRICS
    ext = feeds.imbalance_extremes(trips_medium, k=3, min_activity=50).collect()
    assert len(ext) == 6 and {r.side for r in ext} == {"top", "bottom"}
    chart = feeds.top_stations_chart(trips_medium, k=5).collect()
    assert [r.total_activity for r in chart] == sorted(r.total_activity for r in chart)
    bars = feeds.season_bars(trips_medium).collect()
    assert all(r.bar_label.endswith("% casual") for r in bars)


def test_report_metrics(trips_medium):
    r = report.demand_ratios(trips_medium).first()
    mv = analyses.monthly_trips(trips_medium).collect()
    assert r.peak_trips == max(m.trips for m in mv) and r.trough_trips == min(m.trips for m in mv)
    c = report.station_concentration(trips_medium, k=3).first()
    assert c.total_activity == 2 * trips_medium.count() and 0 < c.top_share_pct <= 100


def test_segment_profile_keeps_null_segment(spark):
    rows = [("member", 10.0), ("member", 20.0), (None, 7.0), (None, 9.0), (None, 30.0)]
    df = spark.createDataFrame(rows, "member_casual string, trip_duration_min double").select(
        "*", F.lit(1.0).alias("trip_distance_km"), F.lit(False).alias("is_round_trip")
    )
    got = {r.member_casual: r.median_duration_min for r in analyses.member_vs_casual(df).collect()}
    assert got == {"member": 10.0, None: 9.0}
