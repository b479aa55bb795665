"""Incremental, idempotent landing with Structured Streaming.

Two file-source streams, each with its own checkpoint, run as catch-up jobs
(``trigger(availableNow=True)``): every file present is processed exactly
once, a re-run processes only files that arrived since, and an interrupted
run resumes from its checkpoint.

* :func:`land_archives`: ZIP archives in a landing folder -> raw-zone CSV, one
  subfolder per batch, so that files dropped beside them stay visible.
* :func:`land_trips`: raw-zone CSV -> cleaned trips in the curated zone. The
  result equals ``clean_trips`` over all files so far, in whatever order they
  arrived: a ride delivered again, in any month, keeps the row that batch
  cleaning would keep, and only month folders that lose a row are rewritten.

The curated zone has a manifest (:mod:`dockflow.sources.zone`): readers see a batch
whole or not at all. A ride index in it (:mod:`dockflow.streaming.ride_index`) tells
where each known ride lies. Rides whose winning row fails a later rule are no trips,
but they still win over other copies; those rows are kept under ``rejected``.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from dockflow import schema
from dockflow.operators.clean import candidate_rides, derive_columns, passes, ride_winners
from dockflow.operators.quality import default_rules
from dockflow.session import settled
from dockflow.sources import zone
from dockflow.sources.archive_source import can_open
from dockflow.sources.archives import archive_blocks, archive_lines, block_lines, parse_trip_lines
from dockflow.sources.curated import write_trips
from dockflow.sources.raw_csv import CSV_FILES, write_raw_trips
from dockflow.sources.zone import Manifest
from dockflow.streaming import ride_index


# Fixed schema of Spark's binaryFile source (streams need it declared).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


ROW_COLUMNS = [*schema.RAW_COLUMNS, "trip_duration_min"]
REJECTED = "rejected"


def land_archives(
    spark: SparkSession,
    archive_dir: str,
    raw_dir: str,
    checkpoint: str,
    *,
    max_files_per_trigger: int | None = None,
    check_header: bool = True,
) -> StreamingQuery:
    """Expand every new ``*.zip`` in ``archive_dir`` into CSV rows under ``raw_dir``."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.zip")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(archive_dir)
    streamed = can_open(archive_dir)  # by path: an archive of any size is read from where it lies
    if streamed:
        files = files.select("path")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if streamed:
            paths = [unquote(r.path) for r in batch.collect()]  # one trigger's new files
            lines = block_lines(archive_blocks(batch.sparkSession, paths, check_header=check_header))
        else:
            lines = archive_lines(batch, check_header=check_header)
        rows = parse_trip_lines(lines).select(*schema.RAW_COLUMNS)
        # A retried batch writes the same folder again.
        write_raw_trips(rows, f"{raw_dir.rstrip('/')}/archives/batch-{batch_id:06d}")

    return files.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_trips(new_raw: DataFrame, curated_dir: str, *, tz: str | None = None, index_buckets: int = ride_index.BUCKETS) -> None:
    """Bring the curated zone to what cleaning all files together would give, adding ``new_raw``.

    The rides of the batch are looked up in the zone's ride index, and only the
    month folders that hold one are read. What is known for a ride and the batch's
    own rows compete by the order of ``ride_winners``. New winners that pass the
    rules go into new folders, together with what is left of folders that hold a
    row which lost; winners that fail a rule are kept beside the zone, since they
    beat other copies too. Readers see all of it at once, with the next manifest
    version. Running it again with the same rows changes nothing, so a retried batch is harmless.
    ``index_buckets``: for the zone's first batch, buckets of the ride index.
    """
    spark = new_raw.sparkSession
    before = zone.read_manifest(spark, curated_dir) or Manifest()
    own = ride_winners(candidate_rides(new_raw, tz=tz)).select(*ROW_COLUMNS)
    own = settled(own, "landing-candidates")
    known = known_rows(spark, curated_dir, before, own)
    rows = own.withColumns({"_new": F.lit(True), "_batch": F.lit(None).cast("string"), "_month": F.lit(None).cast("string")})
    if known is not None:
        rows = known.unionByName(rows)  # of equal rows the known one wins: false comes before true
    changed = settled(ride_winners(rows).where("_new").select(*ROW_COLUMNS), "landing-changed")
    if changed.isEmpty():
        return

    ok = passes(default_rules())
    token = before.next_token()
    trips = derive_columns(changed.where(ok)).select(*schema.CURATED_COLUMNS)
    entries = {(k, b, m) for k, b, m in before.entries if k != ride_index.KIND}
    if known is not None:
        beaten = known.where("_month is not null").join(changed.select("ride_id"), "ride_id", "left_semi").select("ride_id", "_batch", "_month")
        beaten = settled(beaten, "landing-beaten")
        folders = [(r[0], r[1]) for r in beaten.select("_batch", "_month").distinct().collect()]  # month folders
        if folders:
            stay = zone.read_folders(spark, curated_dir, folders).join(beaten.select("ride_id"), "ride_id", "left_anti")
            trips = stay.select(*schema.CURATED_COLUMNS).unionByName(trips)
            entries -= {(zone.DATA, b, m) for b, m in folders}
    write_trips(trips, zone.folder(curated_dir, token))
    months = zone.written_months(spark, curated_dir, token)
    entries |= {(zone.DATA, token, m) for m in months}
    refused = changed.where(~ok)
    refused.write.mode("overwrite").parquet(_rejected(curated_dir, token))
    if not refused.isEmpty():
        entries.add((REJECTED, token, None))

    lies = zone.read_folders(spark, curated_dir, [(token, m) for m in months]).select("ride_id", "batch", F.col(schema.PARTITION_COLUMN).alias("month"))
    lies = lies.unionByName(refused.select("ride_id", F.lit(token).alias("batch"), F.lit(None).cast("string").alias("month")))
    entries |= set(ride_index.append(spark, curated_dir, before, token, lies, index_buckets))
    zone.commit(spark, curated_dir, before, entries)


def known_rows(spark: SparkSession, curated_dir: str, manifest: Manifest, rides: DataFrame) -> DataFrame | None:
    """What the zone holds for ``rides``: ``ROW_COLUMNS``, ``_new`` (false), ``_batch``, ``_month`` (null: refused by a rule).

    The index tells the folders; only their partitions are read, and joined with
    the places found, which Spark broadcasts if they are few.
    """
    found = ride_index.look_up(spark, curated_dir, manifest, rides)
    if found is None:
        return None
    found = settled(found, "landing-known-places")
    places = [(r.batch, r.month) for r in found.select("batch", "month").distinct().collect()]  # folders
    live, refused = [(b, m) for b, m in places if m is not None], sorted(b for b, m in places if m is None)
    place = found.select("ride_id", "batch", F.col("month").alias(schema.PARTITION_COLUMN))
    trips = zone.read_folders(spark, curated_dir, live).where(F.col(schema.PARTITION_COLUMN).isin(sorted({m for _, m in live})))
    trips = trips.join(place, ["ride_id", "batch", schema.PARTITION_COLUMN], "left_semi")
    known = trips.select(*ROW_COLUMNS, F.lit(False).alias("_new"), F.col("batch").alias("_batch"), F.col(schema.PARTITION_COLUMN).alias("_month"))
    if refused:
        kind = StructType([*rides.select(*ROW_COLUMNS).schema.fields, StructField("batch", StringType())])
        base = f"{curated_dir.rstrip('/')}/{REJECTED}"
        rows = spark.read.schema(kind).option("basePath", base).parquet(*[_rejected(curated_dir, b) for b in refused])
        rows = rows.join(found.where("month is null").select("ride_id", "batch"), ["ride_id", "batch"], "left_semi")
        known = known.unionByName(rows.select(*ROW_COLUMNS, F.lit(False).alias("_new"), F.col("batch").alias("_batch"), F.lit(None).cast("string").alias("_month")))
    return settled(known, "landing-known")


def _rejected(curated_dir: str, batch: str) -> str:
    return f"{curated_dir.rstrip('/')}/{REJECTED}/batch={batch}"


def land_trips(
    spark: SparkSession,
    raw_dir: str,
    curated_dir: str,
    checkpoint: str,
    *,
    tz: str | None = None,
    max_files_per_trigger: int | None = 1000,
    file_glob: str = CSV_FILES,
) -> StreamingQuery:
    """Merge every new raw CSV file under ``raw_dir`` (subfolders too) into ``curated_dir``, see :func:`merge_trips`.

    ``max_files_per_trigger`` bounds a batch; a backlog is then worked off in
    several.
    """
    reader = (
        spark.readStream.schema(schema.RAW_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", file_glob)
        .option("recursiveFileLookup", True)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(raw_dir)
    return (
        stream.writeStream.foreachBatch(lambda batch, _: merge_trips(batch, curated_dir, tz=tz))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Block until an ``availableNow`` query has drained its input.

    After ``timeout_s`` the query is stopped and ``TimeoutError`` raised: what
    has landed so far stays, and the next run goes on from the checkpoint.
    """
    ended = query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise query.exception()
    if ended is False:
        query.stop()
        raise TimeoutError(f"the landing query was not done after {timeout_s} s")
    return query


def land_new_files_batch(
    spark: SparkSession,
    raw_dir: str,
    curated_dir: str,
    manifest_dir: str,
    *,
    tz: str | None = None,
    file_glob: str = CSV_FILES,
) -> None:
    """Batch form of :func:`land_trips`: a manifest table of processed files.

    The raw files are listed without reading them; those not in the manifest
    (one row per file) are read, merged and then added to it. A failure in
    between takes the same files again next time, which changes nothing.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", file_glob).option("recursiveFileLookup", True).load(raw_dir)
    files = listing.select(F.col("path").alias("_file"))
    done = zone.landed(spark, manifest_dir, "_file string")
    if done is not None:
        files = files.join(done, "_file", "left_anti")
    paths = [r[0] for r in files.collect()]  # the listing of one run's new files
    if not paths:
        return
    raw = spark.read.schema(schema.RAW_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(paths)
    merge_trips(raw, curated_dir, tz=tz)
    spark.createDataFrame([(p,) for p in paths], "_file string").write.mode("append").parquet(manifest_dir)
