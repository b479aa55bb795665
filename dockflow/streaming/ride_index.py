"""Where each known ride lies: an index bucketed by ride, beside a zone's months.

Rows are ``(ride_id, written, batch, month)``: the ride's row lies in the folders of
``batch``; month is null for a ride whose winning row fails a cleaning rule (it lies
in the zone's ``rejected`` folder). The index row written last holds. Index rows are
appended bucket by bucket, so a look-up joins the index where it lies: only the
rides asked for are shuffled. The zone's manifest names the appends that count, so
rows of a writer that died are never read, and the folder they are in (a
generation). When many appends have piled up, the next generation is written with
one row for each ride.

Spark can use buckets only of a table, so one is declared over the folder for the
time of a plan; nothing stays in the catalog.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources.zone import Manifest

KIND = "rides"
INDEX_COLUMNS = ["ride_id", "written", "batch", "month"]
BUCKETS = 64
#: Appends of a generation from which the next one is written.
MOST_APPENDS = 16


@contextmanager
def _table(spark: SparkSession, zone: str, generation: str) -> Iterator[str]:
    name = f"dockflow_rides_{os.urandom(6).hex()}"
    buckets = int(generation.rsplit("-", 1)[1])
    path = f"{zone.rstrip('/')}/_rides/{generation}"
    spark.sql(
        f"CREATE TABLE {name} (ride_id STRING, written STRING, batch STRING, month STRING) USING parquet "
        f"CLUSTERED BY (ride_id) SORTED BY (ride_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")  # the entry only: the table is external


def new_generation(token: str, buckets: int = BUCKETS) -> str:
    return f"{token}-{buckets}"


def rows_of(spark: SparkSession, zone: str, manifest: Manifest) -> DataFrame | None:
    """All index rows that count, read as buckets; None before the first."""
    appends = manifest.of(KIND)
    if not appends:
        return None
    with _table(spark, zone, appends[-1][1]) as name:
        rows = spark.table(name)
    return rows.where(F.col("written").isin([w for w, _ in appends]))  # MOST_APPENDS at most


def latest(rows: DataFrame) -> DataFrame:
    """The row that holds for each ride."""
    return rows.groupBy("ride_id").agg(F.max(F.struct("written", "batch", "month")).alias("at")).select("ride_id", "at.batch", "at.month")


def look_up(spark: SparkSession, zone: str, manifest: Manifest, rides: DataFrame) -> DataFrame | None:
    """``(ride_id, batch, month)`` of those ``rides`` (distinct ``ride_id``) that are known; None without an index."""
    rows = rows_of(spark, zone, manifest)
    return None if rows is None else latest(rows.join(rides.select("ride_id"), "ride_id"))


def append(spark: SparkSession, zone: str, manifest: Manifest, token: str, added: DataFrame, buckets: int = BUCKETS) -> list[tuple[str, str, str]]:
    """Write ``added`` (``ride_id, batch, month``, a row for each ride) and return the manifest's entries for the index."""
    appends = manifest.of(KIND)
    keep = [(KIND, w, g) for w, g in appends]
    if appends and len(appends) < MOST_APPENDS:
        generation = appends[-1][1]
    else:
        generation = new_generation(token, buckets)
        if appends:
            old = latest(rows_of(spark, zone, manifest).join(added.select("ride_id"), "ride_id", "left_anti"))
            added, keep = old.unionByName(added), []
    rows = added.withColumn("written", F.lit(token)).select(*INDEX_COLUMNS)
    with _table(spark, zone, generation) as name:
        rows.repartition(int(generation.rsplit("-", 1)[1]), "ride_id").sortWithinPartitions("ride_id").write.insertInto(name)
    return [*keep, (KIND, token, generation)]
