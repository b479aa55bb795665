"""A curated zone of immutable month folders, swapped by one manifest file.

::

    <zone>/data/batch=<token>/trip_month=<yyyy-MM>/part-*    written once, never changed
    <zone>/_manifest/version=<n>/part-*                      one file: the folders that are the zone

A writer puts new folders aside and then commits the next manifest version. That
version is one Parquet file, which Spark's commit protocol shows at once or not at
all, so a reader sees the zone before the change or after it, and a writer that dies
in between leaves folders that nobody reads. Folders no longer listed stay until
someone deletes them (:func:`expired_folders` names them), so readers that began
earlier can finish. One writer at a time: a second one that commits the same version
fails. Works on any path Spark can write.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow import schema

#: The curated columns' types, so that a zone without a file yet can be read.
CURATED_SCHEMA = (
    "ride_id string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz, start_station_name string, "
    "start_station_id string, end_station_name string, end_station_id string, start_lat double, start_lng double, end_lat double, "
    "end_lng double, member_casual string, trip_duration_min double, trip_date date, trip_year int, hour int, day_of_week string, "
    "is_weekend boolean, season string, time_of_day string, trip_distance_km double, route string, is_round_trip boolean, trip_month string"
)
MANIFEST_SCHEMA = "kind string, batch string, month string"
DATA = "data"


@dataclass(frozen=True)
class Manifest:
    """One version of a zone: (kind, batch, month) entries; kind ``data`` names the month folders."""

    version: int = 0
    entries: frozenset[tuple[str, str, str | None]] = field(default_factory=frozenset)

    def of(self, kind: str) -> list[tuple[str, str | None]]:
        return sorted(((b, m) for k, b, m in self.entries if k == kind), key=repr)

    def next_token(self) -> str:
        """A name for the folders of the next version; later versions sort later."""
        return f"{self.version + 1:09d}-{os.urandom(4).hex()}"


def landed(spark: SparkSession, path: str, kind: str, **options: str) -> DataFrame | None:
    """The Parquet table at ``path`` if it is there yet (any Hadoop-compatible path)."""
    try:
        return spark.read.schema(kind).options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_manifest(spark: SparkSession, zone: str) -> Manifest | None:
    """The latest version, or None where there is no manifest (a plain folder of months, or nothing)."""
    rows = landed(spark, f"{zone.rstrip('/')}/_manifest", f"{MANIFEST_SCHEMA}, version long")
    if rows is None:
        return None
    last = rows.agg(F.max("version")).first()[0]
    if last is None:
        return Manifest()
    found = rows.where(F.col("version") == last).collect()  # a row for each folder
    return Manifest(last, frozenset((r.kind, r.batch, r.month) for r in found if r.kind))


def commit(spark: SparkSession, zone: str, before: Manifest, entries: Iterable[tuple[str, str, str | None]]) -> Manifest:
    """Make ``entries`` the version after ``before``; fails if another writer has made that version."""
    after = Manifest(before.version + 1, frozenset(entries))
    path = f"{zone.rstrip('/')}/_manifest/version={after.version}"
    rows = [*sorted(after.entries, key=repr), ("", "", None)]  # one row at least
    writer = spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write
    try:
        writer.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        now = read_manifest(spark, zone)
        if now is not None and now.version >= after.version:
            raise RuntimeError(f"another writer has changed {zone} since version {before.version}") from e
        writer.mode("overwrite").parquet(path)  # what a writer that died has left
    return after


def folder(zone: str, batch: str, month: str | None = None) -> str:
    base = f"{zone.rstrip('/')}/{DATA}/batch={batch}"
    return base if month is None else f"{base}/{schema.PARTITION_COLUMN}={month}"


def read_folders(spark: SparkSession, zone: str, folders: Iterable[tuple[str, str]]) -> DataFrame:
    """Rows of (batch, month) folders, with their ``batch``; only these are listed."""
    paths = [folder(zone, b, m) for b, m in folders]
    kind = f"{CURATED_SCHEMA.rsplit(',', 1)[0]}, batch string, {schema.PARTITION_COLUMN} string"
    if not paths:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("basePath", f"{zone.rstrip('/')}/{DATA}").parquet(*paths)


def read_zone(spark: SparkSession, zone: str, manifest: Manifest, months: Iterable[str] | None = None) -> DataFrame:
    """The trips of a manifest version, of some months only if given."""
    wanted = None if months is None else set(months)
    live = [(b, m) for b, m in manifest.of(DATA) if wanted is None or m in wanted]
    return read_folders(spark, zone, live).select(*schema.CURATED_COLUMNS)


def written_months(spark: SparkSession, zone: str, batch: str) -> list[str]:
    """The months that a batch's folders hold (a listing, not a scan)."""
    rows = landed(spark, folder(zone, batch), CURATED_SCHEMA)
    return [] if rows is None else sorted(r[0] for r in rows.select(schema.PARTITION_COLUMN).distinct().collect())


def replace_months(trips: DataFrame, zone: str, months: Iterable[str], write) -> Manifest:
    """Make ``trips`` all that the zone holds of ``months`` (none left: the month is empty); the other months stay.

    ``write(trips, path)`` writes month folders, as :func:`dockflow.sources.curated.write_trips`.
    Readers see the old months until the new ones are whole.
    """
    spark = trips.sparkSession
    before = read_manifest(spark, zone) or Manifest()
    if any(k == "rides" for k, _, _ in before.entries):
        raise ValueError(f"{zone} has a ride index; merge rows into it instead")
    months = set(months)
    token = before.next_token()
    write(trips.where(F.col(schema.PARTITION_COLUMN).isin(sorted(months))), folder(zone, token))
    kept = {e for e in before.entries if not (e[0] == DATA and e[2] in months)}
    return commit(spark, zone, before, kept | {(DATA, token, m) for m in written_months(spark, zone, token)})


def expired_folders(spark: SparkSession, zone: str) -> list[str]:
    """Month folders that the latest version doesn't list, for a store's clean-up to delete."""
    manifest = read_manifest(spark, zone) or Manifest()
    rows = landed(spark, f"{zone.rstrip('/')}/{DATA}", f"{CURATED_SCHEMA.rsplit(',', 1)[0]}, batch string, {schema.PARTITION_COLUMN} string")
    if rows is None:
        return []
    there = {(r[0], r[1]) for r in rows.select("batch", schema.PARTITION_COLUMN).distinct().collect()}
    return [folder(zone, b, m) for b, m in sorted(there - set(manifest.of(DATA)))]
