"""Station flow: departures, arrivals and net outflow per station.

Stations are nodes and trips directed edges. Instead of aggregating
departures and arrivals in two scans and joining them, every trip emits its
two endpoint events in one scan (``inline`` of a two-element array) and a
single ``groupBy(station)`` sums them. The aggregation is partial on the map
side, so a station holding a third of all endpoints still moves one row per
task through the shuffle. The literal join forms are kept as
``station_imbalance_by_join`` (full outer) and ``draining_by_join`` (inner) for
users who want the two-aggregate shape; tests check both agree.

Sign convention: ``net_outflow = departures - arrivals``; positive stations
drain empty and need bikes brought in, negative ones fill up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions import percent, time_of_day
from dockflow.operators.sequence import with_rank

DEFAULT_MIN_ACTIVITY = 5000


def station_events(trips: DataFrame, start_extra: Sequence[Column] = (), end_extra: Sequence[Column] = ()) -> DataFrame:
    """One row per trip endpoint: ``station, departures (0/1), arrivals (0/1)[, extra]``.

    ``start_extra``/``end_extra`` are aliased Columns evaluated per endpoint
    (same names on both sides), e.g. the daypart of the departure or arrival.
    """
    start = F.struct(
        F.col("start_station_name").alias("station"),
        F.lit(1).alias("departures"),
        F.lit(0).alias("arrivals"),
        *start_extra,
    )
    end = F.struct(
        F.col("end_station_name").alias("station"),
        F.lit(0).alias("departures"),
        F.lit(1).alias("arrivals"),
        *end_extra,
    )
    return trips.select(F.inline(F.array(start, end)))


def station_flow(trips: DataFrame) -> DataFrame:
    """``station, departures, arrivals`` over all trips (one scan)."""
    return station_events(trips).groupBy("station").agg(
        F.sum("departures").alias("departures"),
        F.sum("arrivals").alias("arrivals"),
    )


def _with_net(flow: DataFrame) -> DataFrame:
    total = F.col("departures") + F.col("arrivals")
    net = F.col("departures") - F.col("arrivals")
    return flow.select(
        *[c for c in flow.columns],
        net.alias("net_outflow"),
        percent(net, total, 1).alias("net_outflow_pct"),
    )


def top_stations_from_flow(flow: DataFrame, k: int = 25) -> DataFrame:
    """The ``k`` stations with most departures + arrivals, from a station flow."""
    return (
        flow.select("station", "departures", "arrivals", (F.col("departures") + F.col("arrivals")).alias("total_activity"))
        .orderBy(F.desc("total_activity"), "station")
        .limit(k)
    )


def top_stations(trips: DataFrame, k: int = 25) -> DataFrame:
    """The ``k`` stations with most departures + arrivals."""
    return top_stations_from_flow(station_flow(trips), k)


def net_outflow(flow: DataFrame, min_activity: int = DEFAULT_MIN_ACTIVITY) -> DataFrame:
    """Net outflow per station with at least ``min_activity`` events, in no order (for further work)."""
    return _with_net(flow.filter(F.col("departures") + F.col("arrivals") >= min_activity))


def imbalance_from_flow(flow: DataFrame, min_activity: int = DEFAULT_MIN_ACTIVITY) -> DataFrame:
    """Net outflow per station with at least ``min_activity`` events, largest first."""
    return net_outflow(flow, min_activity).orderBy(F.desc("net_outflow"), "station")


def station_imbalance(trips: DataFrame, min_activity: int = DEFAULT_MIN_ACTIVITY) -> DataFrame:
    """Net outflow per station with at least ``min_activity`` events, largest first."""
    return imbalance_from_flow(station_flow(trips), min_activity)


def station_imbalance_by_join(trips: DataFrame, min_activity: int = DEFAULT_MIN_ACTIVITY) -> DataFrame:
    """Same result as :func:`station_imbalance` via two aggregates and a full outer join."""
    dep = trips.groupBy(F.col("start_station_name").alias("station")).agg(F.count(F.lit(1)).alias("departures"))
    arr = trips.groupBy(F.col("end_station_name").alias("station")).agg(F.count(F.lit(1)).alias("arrivals"))
    joined = dep.alias("d").join(arr.alias("a"), F.col("d.station") == F.col("a.station"), "full_outer")
    flow = joined.select(
        F.coalesce(F.col("d.station"), F.col("a.station")).alias("station"),
        F.coalesce(F.col("departures"), F.lit(0)).alias("departures"),
        F.coalesce(F.col("arrivals"), F.lit(0)).alias("arrivals"),
    ).filter(F.col("departures") + F.col("arrivals") >= min_activity)
    return _with_net(flow).orderBy(F.desc("net_outflow"), "station")


def draining_from_flow(flow: DataFrame, min_activity: int = DEFAULT_MIN_ACTIVITY, k: int = 5) -> DataFrame:
    """The ``k`` stations losing most bikes among stations with both departures
    and arrivals (inner-join semantics) and enough activity."""
    kept = flow.filter(
        (F.col("departures") > 0)
        & (F.col("arrivals") > 0)
        & (F.col("departures") + F.col("arrivals") >= min_activity)
    )
    return (
        kept.select("station", (F.col("departures") - F.col("arrivals")).alias("net_outflow"))
        .orderBy(F.desc("net_outflow"), "station")
        .limit(k)
    )


def top_draining_stations(trips: DataFrame, min_activity: int = DEFAULT_MIN_ACTIVITY, k: int = 5) -> DataFrame:
    """The ``k`` stations losing most bikes, among stations with both departures
    and arrivals (inner-join semantics) and enough activity."""
    return draining_from_flow(station_flow(trips), min_activity, k)


def draining_by_join(trips: DataFrame, min_activity: int = DEFAULT_MIN_ACTIVITY, k: int = 5) -> DataFrame:
    """:func:`top_draining_stations` in the two-aggregate inner-join form."""
    dep = trips.groupBy(F.col("start_station_name").alias("station")).agg(F.count(F.lit(1)).alias("departures"))
    arr = trips.groupBy(F.col("end_station_name").alias("station")).agg(F.count(F.lit(1)).alias("arrivals"))
    joined = dep.join(arr, "station", "inner").filter(F.col("departures") + F.col("arrivals") >= min_activity)
    return (
        joined.select("station", (F.col("departures") - F.col("arrivals")).alias("net_outflow"))
        .orderBy(F.desc("net_outflow"), "station")
        .limit(k)
    )


def intraday_from_counts(counts: DataFrame, min_activity: int = 0) -> DataFrame:
    """Net outflow per station and daypart from rows of
    ``station, time_of_day, departures, arrivals`` (partial counts)."""
    flow = counts.groupBy("station", "time_of_day").agg(
        F.sum("departures").alias("departures"),
        F.sum("arrivals").alias("arrivals"),
    )
    flow = flow.filter(F.col("departures") + F.col("arrivals") >= min_activity)
    return _with_net(flow).orderBy("station", "time_of_day")


def intraday_imbalance(trips: DataFrame, min_activity: int = 0) -> DataFrame:
    """Net outflow per station and daypart; a departure counts in the daypart
    of its start time, an arrival in the daypart of its end time."""
    events = station_events(
        trips,
        start_extra=[time_of_day(F.hour("started_at")).alias("time_of_day")],
        end_extra=[time_of_day(F.hour("ended_at")).alias("time_of_day")],
    )
    return intraday_from_counts(events, min_activity)


def pairs_from_imbalance(imbalance: DataFrame) -> DataFrame:
    """Pair the i-th strongest sink with the i-th strongest source.

    Output: ``pair_rank, from_station, from_surplus, to_station, to_deficit,
    bikes_to_move``: move bikes out of ``from_station`` (fills up) into
    ``to_station`` (drains). Stations are ranked within their side by
    ``|net_outflow|`` then name, by range partitions and their sizes, so no task
    sorts a whole side; each rank's sink and source are brought together by an
    aggregation on the rank, not a join. The ranked stations are written to the
    checkpoint folder when this is called. ``imbalance`` may be in any order.
    """
    net = F.col("net_outflow")
    side = F.when(net < 0, F.lit("sink")).when(net > 0, F.lit("source"))
    sides = imbalance.select("station", net, side.alias("_side")).filter(F.col("_side").isNotNull())
    ranked = with_rank(sides, "_side", [F.desc(F.abs(net)), F.col("station")], "pair_rank")
    sink, source = F.col("_side") == "sink", F.col("_side") == "source"
    pairs = ranked.groupBy("pair_rank").agg(
        F.max(F.when(sink, F.col("station"))).alias("from_station"),
        F.max(F.when(sink, -net)).alias("from_surplus"),
        F.max(F.when(source, F.col("station"))).alias("to_station"),
        F.max(F.when(source, net)).alias("to_deficit"),
    )
    return (
        pairs.filter(F.col("from_station").isNotNull() & F.col("to_station").isNotNull())
        .withColumn("bikes_to_move", F.least("from_surplus", "to_deficit"))
        .orderBy("pair_rank")
    )


def rebalancing_pairs(trips: DataFrame, min_activity: int = DEFAULT_MIN_ACTIVITY) -> DataFrame:
    """Sink -> source pairs by rank of imbalance (see :func:`pairs_from_imbalance`)."""
    return pairs_from_imbalance(net_outflow(station_flow(trips), min_activity))
