"""Curated zone: trips as Parquet partitioned by ``trip_month``.

Paths are plain strings, so the same code reads a local folder, HDFS or an
object store (``s3a://``, ``abfss://``, ``gs://``); connector settings belong
to the session (see :func:`object_store_conf`).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.session import settled
from dockflow.sources import zone


def write_trips(
    trips: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    dynamic_overwrite: bool = False,
    max_records_per_file: int | None = 5_000_000,
) -> None:
    """Write curated trips partitioned by month.

    ``rebalance(trip_month)`` asks AQE for evenly sized output partitions
    clustered by month; a month far larger than the rest is split across
    several tasks instead of funnelling into one (as ``repartition(month)``
    would). Sorting by ``started_at`` inside each file makes row-group
    statistics selective for time filters. An overwrite replaces the whole
    dataset; with ``dynamic_overwrite`` only the months present in ``trips``.
    """
    out = trips.hint("rebalance", schema.PARTITION_COLUMN).sortWithinPartitions(schema.PARTITION_COLUMN, "started_at")
    writer = out.write.mode(mode).partitionBy(schema.PARTITION_COLUMN)
    writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic_overwrite else "static")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.parquet(path)


def read_trips(spark: SparkSession, path: str, months: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Read curated trips, from a plain folder of months or a zone with a manifest.

    ``months`` (``yyyy-MM``) prunes partitions: a list as a filter, a table with a
    column ``trip_month`` as a semi-join, whose months Spark finds at run time and
    then lists only their folders (dynamic partition pruning).
    """
    listed = None if months is None or isinstance(months, DataFrame) else list(months)
    manifest = zone.read_manifest(spark, path)
    df = spark.read.parquet(path) if manifest is None else zone.read_zone(spark, path, manifest, listed)
    if listed is not None:
        df = df.filter(F.col(schema.PARTITION_COLUMN).isin(listed))
    if isinstance(months, DataFrame):
        df = df.join(months.select(schema.PARTITION_COLUMN), schema.PARTITION_COLUMN, "left_semi").select(*df.columns)
    return df


def register_trips(spark: SparkSession, trips: DataFrame, name: str = "trips") -> DataFrame:
    """Register ``trips`` as a temp view for SQL users."""
    trips.createOrReplaceTempView(name)
    return trips


def publish_trips(trips: DataFrame, uri: str) -> None:
    """Publish the curated zone to another store (same layout), replacing what is there."""
    write_trips(trips, uri, mode="overwrite")


PUBLISHED = "published"
FILE_SCHEMA = "trip_month string, file string, length long, modified timestamp"


def month_files(spark: SparkSession, path: str) -> DataFrame:
    """``(trip_month, file, length, modified)`` of a zone's files: a listing, no file is opened."""
    manifest = zone.read_manifest(spark, path)
    folders = [path] if manifest is None else [zone.folder(path, b, m) for b, m in manifest.of(zone.DATA)]
    if not folders:
        return spark.createDataFrame([], FILE_SCHEMA)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folders)
    month = F.regexp_extract("path", f"/{schema.PARTITION_COLUMN}=([^/]+)/[^/]+$", 1)
    return listing.select(month.alias(schema.PARTITION_COLUMN), F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "length", F.col("modificationTime").alias("modified")).where(month != "")


def publish_changes(spark: SparkSession, source: str, target: str, *, remove: bool = False) -> DataFrame:
    """Bring the zone at ``target`` up to the curated zone at ``source``, and return ``(trip_month, action)``.

    A month is copied (``new`` or ``changed``) if the name, length or time of any of
    its files differs from what was published last; ``same`` months are neither read
    nor written. Months that are gone from the source are ``kept``, or ``removed`` if
    asked for. What is compared are two listings, by anti-joins. Readers of the target
    see the change at once, with its next manifest version.
    """
    before = zone.read_manifest(spark, target) or zone.Manifest()
    here = settled(month_files(spark, source), "source-files")
    last = [b for b, _ in before.of(PUBLISHED)]
    there = spark.read.schema(FILE_SCHEMA).parquet(f"{target.rstrip('/')}/_{PUBLISHED}/batch={last[0]}") if last else spark.createDataFrame([], FILE_SCHEMA)
    own = here.columns
    unlike = here.join(there, own, "left_anti").unionByName(there.join(here, own, "left_anti")).select(schema.PARTITION_COLUMN).distinct()
    month_of = lambda df, name: df.select(schema.PARTITION_COLUMN).distinct().withColumn(name, F.lit(True))
    months = month_of(here, "_here").join(month_of(there, "_there"), schema.PARTITION_COLUMN, "full").join(unlike.withColumn("_unlike", F.lit(True)), schema.PARTITION_COLUMN, "left")
    action = (
        F.when(F.col("_here").isNull(), "removed" if remove else "kept").when(F.col("_there").isNull(), "new").when(F.col("_unlike"), "changed").otherwise("same"))
    done = settled(months.select(schema.PARTITION_COLUMN, action.alias("action")), "publish-actions")
    by_action: dict[str, set[str]] = {}
    for r in done.collect():  # a row for each month
        by_action.setdefault(r.action, set()).add(r[0])
    copied = by_action.get("new", set()) | by_action.get("changed", set())
    gone = by_action.get("removed", set())
    if copied or gone:
        token = before.next_token()
        entries = {e for e in before.entries if e[0] == zone.DATA and e[2] not in copied | gone}
        if copied:
            write_trips(read_trips(spark, source, months=sorted(copied)), zone.folder(target, token))
            entries |= {(zone.DATA, token, m) for m in zone.written_months(spark, target, token)}
        kept = there.where(F.col(schema.PARTITION_COLUMN).isin(sorted(by_action.get("kept", set()))))
        here.unionByName(kept).coalesce(1).write.mode("overwrite").parquet(f"{target.rstrip('/')}/_{PUBLISHED}/batch={token}")
        zone.commit(spark, target, before, entries | {(PUBLISHED, token, None)})
    return done


def object_store_conf(endpoint: str | None = None, provider: str | None = None) -> dict[str, str]:
    """Session settings for an ``s3a://`` store; pass to ``SparkSession.builder.config``.

    The connector jars must already be on the classpath of the cluster.
    """
    conf = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if provider:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = provider
    return conf
