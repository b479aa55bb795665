"""Named query catalog: name -> DataFrame function, plus a runner.

``TRIP_QUERIES`` take curated trips; ``RAW_QUERIES`` take raw rows. Parameters
default to the values used at full scale; ``run_catalog`` accepts overrides.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from functools import partial
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.operators import analyses, clean, flows
from dockflow.plans import feeds, report

TRIP_QUERIES: dict[str, Callable[..., DataFrame]] = {
    "monthly_volume": analyses.monthly_volume,
    "usage_by_bike_type": analyses.usage_by_bike_type,
    "member_vs_casual": analyses.member_vs_casual,
    "member_vs_casual_approx": partial(analyses.member_vs_casual, median_accuracy=1_000_000),
    "trip_patterns_by_dow": analyses.trip_patterns_by_dow,
    "hourly_demand": analyses.hourly_demand,
    "time_of_day_demand": analyses.time_of_day_demand,
    "top_routes": analyses.top_routes,
    "top_stations": flows.top_stations,
    "station_imbalance": flows.station_imbalance,
    "seasonal_demand": analyses.seasonal_demand,
    "monthly_trips": analyses.monthly_trips,
    "top_draining_stations": flows.top_draining_stations,
    "station_imbalance_by_join": flows.station_imbalance_by_join,
    "draining_by_join": flows.draining_by_join,
    "monthly_stack": feeds.monthly_stack,
    "hourly_lines": feeds.hourly_lines,
    "season_bars": feeds.season_bars,
    "segment_comparison": feeds.segment_comparison,
    "top_stations_chart": feeds.top_stations_chart,
    "imbalance_extremes": feeds.imbalance_extremes,
    "demand_ratios": report.demand_ratios,
    "station_concentration": report.station_concentration,
    "intraday_imbalance": flows.intraday_imbalance,
    "rebalancing_pairs": flows.rebalancing_pairs,
    "commuter_routes": report.commuter_routes,
    "summer_weekend_casual": report.summer_weekend_casual,
}

RAW_QUERIES: dict[str, Callable[..., DataFrame]] = {
    "clean_trips": clean.clean_trips,
    "quality_funnel": clean.quality_funnel,
    "virtual_zones": report.virtual_zones,
}

# The ten core analyses (Q01-Q10), in their numbered order.
CORE_ANALYSES = [
    "monthly_volume",
    "usage_by_bike_type",
    "member_vs_casual",
    "trip_patterns_by_dow",
    "hourly_demand",
    "time_of_day_demand",
    "top_routes",
    "top_stations",
    "station_imbalance",
    "seasonal_demand",
]


def bind(name: str, params: Mapping[str, object] | None = None) -> Callable[[DataFrame], DataFrame]:
    """The catalog function ``name`` with keyword parameters bound."""
    fn = TRIP_QUERIES.get(name) or RAW_QUERIES.get(name)
    if fn is None:
        raise KeyError(f"unknown query {name!r}")
    return partial(fn, **dict(params or {}))


def run_catalog(
    trips: DataFrame,
    names: Iterable[str] | None = None,
    params: Mapping[str, Mapping[str, object]] | None = None,
) -> dict[str, DataFrame]:
    """Build (lazily) every requested trips query; raises if none is selected."""
    selected = list(names) if names is not None else list(CORE_ANALYSES)
    if not selected:
        raise ValueError("no queries selected")
    params = params or {}
    out = {}
    for name in selected:
        if name not in TRIP_QUERIES:
            raise KeyError(f"{name!r} is not a trips query")
        out[name] = bind(name, params.get(name))(trips)
    return out


def load_statements(spark: SparkSession, path: str) -> dict[str, str]:
    """Name -> text of the ``.sql`` statements at ``path``, sorted by name, without a trailing ``;``.

    Spark reads them, so any path it can open will do: a folder of ``name.sql`` files
    (or folders of that name, as Spark writes a text), or a pattern.
    """
    where = path if any(c in path for c in "*?[{") or path.rstrip("/").endswith(".sql") else f"{path.rstrip('/')}/*.sql"
    try:
        texts = spark.read.text(where, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no .sql files in {path}") from e
    parts: dict[str, list[str]] = {}
    for r in texts.orderBy("file").collect():  # a query catalog: some statements
        name = next(x for x in reversed(unquote(r.file).split("/")) if x.endswith(".sql")).removesuffix(".sql")
        parts.setdefault(name, []).append(r.value)
    return {name: "".join(text).strip().rstrip(";").strip() for name, text in sorted(parts.items())}


def run_sql_files(
    spark: SparkSession, trips: DataFrame, sql_dir: str, view: str = "trips", params: Mapping[str, object] | None = None,
) -> dict[str, DataFrame]:
    """Run every statement of :func:`load_statements` against ``trips``, each a lazy result.

    ``trips`` is registered as the temp view ``view``. ``params`` are values of named
    markers (``:min_activity``); a statement gets those it names. Raises if the
    folder holds no ``.sql`` file.
    """
    statements = load_statements(spark, sql_dir)
    trips.createOrReplaceTempView(view)
    params = dict(params or {})
    own = lambda text: {k: v for k, v in params.items() if re.search(rf":{re.escape(k)}\b", text)}
    return {name: spark.sql(text, args=own(text)) if own(text) else spark.sql(text) for name, text in statements.items()}
