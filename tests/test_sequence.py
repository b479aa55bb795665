"""Skew-safe successor lookup equals a plain per-key lead()."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from dockflow.operators.sequence import with_next


def _brute(df):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return df.select("*", F.lead("ts").over(w).alias("ts_next"), F.lead("k").over(w).alias("k_next"))


def _rows(df):
    return sorted(tuple(r) for r in df.select("event_id", "ts_next", "k_next").collect())


def test_matches_plain_lead_on_events(events_small):
    ev = events_small.select("event_id", "ts", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    for unit in ("HOUR", "DAY", "MINUTE"):
        got = with_next(ev, key="user_id", order=["ts", "event_id"], carry=["ts", "k"], bucket_unit=unit)
        assert _rows(got) == _rows(_brute(ev)), unit


def test_gaps_ties_and_nulls(spark):
    t = dt.datetime
    rows = [
        (1, t(2024, 1, 1, 0, 5), 7, None),   # carried value NULL must not count as "no successor"
        (2, t(2024, 1, 1, 0, 5), 7, 3),      # same ts, tie broken by event_id
        (3, t(2024, 1, 1, 9, 0), 7, 4),      # next bucket after an empty gap
        (4, t(2024, 1, 3, 0, 0), 7, 5),      # days later
        (5, t(2024, 1, 1, 0, 0), 8, 6),      # single-row key
    ]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, k int")
    got = {r.event_id: (r.ts_next, r.k_next) for r in
           with_next(df, key="user_id", order=["ts", "event_id"], carry=["ts", "k"]).collect()}
    assert got[1] == (t(2024, 1, 1, 0, 5), 3)
    assert got[2] == (t(2024, 1, 1, 9, 0), 4)
    assert got[3] == (t(2024, 1, 3, 0, 0), 5)
    assert got[4] == (None, None)
    assert got[5] == (None, None)
    # A successor whose carried value is NULL still counts as a successor.
    rows_null = [(1, t(2024, 1, 1, 0, 0), 9, 1), (2, t(2024, 1, 1, 3, 0), 9, None)]
    df2 = spark.createDataFrame(rows_null, "event_id long, ts timestamp_ntz, user_id long, k int")
    got2 = {r.event_id: (r.ts_next, r.k_next) for r in
            with_next(df2, key="user_id", order=["ts", "event_id"], carry=["ts", "k"]).collect()}
    assert got2[1] == (t(2024, 1, 1, 3, 0), None)
    assert got2[2] == (None, None)


def test_no_window_partitioned_by_key_alone_on_rows(events_small):
    """The row-level window is keyed by (key, bucket); only bucket heads see a key-only window."""
    ev = events_small.select("event_id", "ts", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    out = with_next(ev, key="user_id", order=["ts", "event_id"], carry=["ts", "k"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_seq_bucket" in plan and "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_key_spread_over_buckets(spark):
    """One user with a third of all rows: same result as lead(), and its rows
    are windowed in many (user, bucket) groups rather than one."""
    n = 6000
    df = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 97 + 2).cast("long").alias("user_id"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(mins=(F.col("id") * 7 % 5000).cast("int"))).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 100).cast("int").alias("k"),
    )
    got = with_next(df, key="user_id", order=["ts", "event_id"], carry=["ts", "k"])
    assert _rows(got) == _rows(_brute(df))
    buckets = df.filter("user_id = 1").select(F.date_trunc("HOUR", "ts")).distinct().count()
    assert buckets > 50


def test_null_keys_and_times_match_lead(spark):
    t = dt.datetime
    rows = [
        (1, t(2024, 1, 1, 0, 5), None, 1),
        (2, t(2024, 1, 1, 3, 0), None, 2),   # NULL key, next bucket
        (3, None, 5, 3),                      # NULL time sorts first
        (4, t(2024, 1, 1, 1, 0), 5, 4),
        (5, None, None, 5),
    ]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, k int")
    got = with_next(df, key="user_id", order=["ts", "event_id"], carry=["ts", "k"])
    assert _rows(got) == _rows(_brute(df))


def test_big_side_shuffled_once(spark, events_small):
    """Without broadcast, the row-level input is shuffled once: the join reuses
    the bucket window's partitioning."""
    ev = events_small.select("event_id", "ts", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    try:
        plan = with_next(ev, key="user_id", order=["ts", "event_id"], carry=["ts", "k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    col = lines[at].index("+-") + 3  # children of the join are marked at this column
    left = []
    for line in lines[at + 1:]:
        if len(line) > col and line[col] == "+":
            break  # right child starts
        left.append(line)
    assert sum("Exchange hashpartitioning" in line for line in left) == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(
            st.sampled_from([None, 1, 2, 3]),
            st.one_of(st.none(), st.integers(min_value=0, max_value=72 * 60).map(lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m))),
            st.integers(min_value=0, max_value=99),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_with_next_matches_lead_on_random_rows(spark, data):
    rows = [(i, ts, user, k) for i, (user, ts, k) in enumerate(data)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, k int")
    got = with_next(df, key="user_id", order=["ts", "event_id"], carry=["ts", "k"])
    assert _rows(got) == _rows(_brute(df))
