"""Data-quality operators: required fields, de-duplication, range rules, funnel.

Every operator is lazy ``DataFrame -> DataFrame``.

De-duplication keeps, per key, the row that sorts first on the given columns
and then on all remaining columns, so the survivor is the same on every run
and with any partitioning. It is written as ``row_number() = 1``, which Spark
plans as a sort-based ``WindowGroupLimit`` on both sides of the shuffle: each
map task keeps only its best row per key before shuffling, so a key that holds
millions of copies sends one row per map task, never one task's worth of rows
(the same guarantee as a partial aggregation, in generated code). This relies
on ``spark.sql.optimizer.windowGroupLimitThreshold`` being at least 1 (its
default is 1000; ``session.scale_conf`` sets it explicitly).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.functions import BBox, SERVICE_AREA, trip_within_bbox


@dataclass(frozen=True)
class Rule:
    """A named row filter of the cleaning funnel.

    ``columns``: what ``keep`` reads, if stated; the funnel carries nothing else.
    """

    name: str
    keep: Column
    columns: tuple[str, ...] | None = None


STEP_DURATION = "duration in range"
STEP_AREA = "both ends in the service area"
FLOAT_COLUMNS = frozenset(f.name for f in schema.RAW_SCHEMA.fields if f.dataType.simpleString() in ("double", "float"))
COORDINATES = ("start_lat", "start_lng", "end_lat", "end_lng")


def required_present(columns: Sequence[str] = schema.REQUIRED_COLUMNS) -> Column:
    """True when none of ``columns`` is NULL or, of the numbers among the raw columns, NaN."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
        if c in FLOAT_COLUMNS:
            cond = cond & ~F.isnan(c)
    return cond


def drop_missing(df: DataFrame, columns: Sequence[str] = schema.REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows where any required column is NULL or NaN."""
    return df.dropna(how="any", subset=list(columns))


def duration_between(lo: float = schema.MIN_DURATION_MIN, hi: float = schema.MAX_DURATION_MIN,
                     col: str = "trip_duration_min") -> Column:
    """Strict window ``lo < duration < hi``."""
    return (F.col(col) > F.lit(lo)) & (F.col(col) < F.lit(hi))


def filter_duration(df: DataFrame, lo: float = schema.MIN_DURATION_MIN, hi: float = schema.MAX_DURATION_MIN) -> DataFrame:
    return df.filter(duration_between(lo, hi))


def filter_bbox(df: DataFrame, box: BBox = SERVICE_AREA) -> DataFrame:
    return df.filter(trip_within_bbox(box))


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the least on ``order`` then on every other column.

    Deterministic replacement for ``dropDuplicates(key)`` (all columns must be
    orderable); skew-safe through the map-side group limit (see module doc).
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = list(dict.fromkeys(order))
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_first_rank", F.row_number().over(w)).filter(F.col("_first_rank") == 1).drop("_first_rank")


def default_rules(box: BBox = SERVICE_AREA, lo: float = schema.MIN_DURATION_MIN,
                  hi: float = schema.MAX_DURATION_MIN) -> list[Rule]:
    """The post-dedupe rules, in order."""
    return [
        Rule(STEP_DURATION, duration_between(lo, hi), ("trip_duration_min",)),
        Rule(STEP_AREA, trip_within_bbox(box), COORDINATES),
    ]
