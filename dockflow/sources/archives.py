"""Monthly ZIP archives -> raw trip rows, as a Spark job.

Archives are read through the ``trip_archives`` data source
(:mod:`dockflow.sources.archive_source`): one partition an archive, inflated block by
block from where it lies, so its size doesn't matter. Paths that only Hadoop opens go
through ``binaryFile`` instead, where an archive is one value of at most 2 GB. Lines
are split and parsed (``from_csv`` with the declared raw schema) in the JVM. Member
choice: the first file ending in ``.csv`` (any case) that is no macOS by-product; an
archive without one fails the job with its path in the message. Quoted fields
spanning lines are not supported (trip files have none).
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.session import ship
from dockflow.sources.archive_source import BLOCK_SCHEMA, TripArchives, can_open, pick_csv_member, text_blocks

__all__ = ["archive_lines", "parse_trip_lines", "pick_csv_member", "read_archived_trips", "write_archived_trips"]


def _blocks(batches: Iterator[pa.RecordBatch], expected_header: str | None = None) -> Iterator[pa.RecordBatch]:
    """Blocks of the archives in ``binaryFile`` rows."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            yield from text_blocks(path, io.BytesIO(content), expected_header)


def _source(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(TripArchives)


def _header(check: bool) -> str | None:
    return ",".join(schema.RAW_COLUMNS) if check else None


def archive_blocks(spark: SparkSession, paths: list[str], check_header: bool = False) -> DataFrame:
    """Text blocks of the archives at ``paths``, one partition each."""
    _source(spark)
    reader = spark.read.format("trip_archives").option("paths", "\n".join(paths))
    return (reader.option("header", _header(True)) if check_header else reader).load()


def archive_lines(files: DataFrame, check_header: bool = False) -> DataFrame:
    """``binaryFile`` rows (``path``, ``content``) -> :func:`block_lines`."""
    ship(files.sparkSession)
    return block_lines(files.select("path", "content").mapInArrow(partial(_blocks, expected_header=_header(check_header)), BLOCK_SCHEMA))


def block_lines(blocks: DataFrame) -> DataFrame:
    """Text blocks -> one row per CSV line: ``archive, member, line_no, line``; lines are split in the JVM."""
    lines = blocks.select("archive", "member", "first_line", F.posexplode(F.split("text", "\r?\n", -1)).alias("_at", "line"))
    return lines.select("archive", "member", (F.col("first_line") + F.col("_at")).alias("line_no"), F.rtrim(F.col("line"), F.lit("\r")).alias("line"))


def parse_trip_lines(lines: DataFrame) -> DataFrame:
    """Parse CSV lines (header = line 0 of each member) with ``schema.RAW_SCHEMA``.

    Adds ``source_archive`` and ``source_member`` for lineage.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.RAW_SCHEMA.fields)
    body = lines.filter(F.col("line_no") > 0).filter(F.length("line") > 0)
    parsed = body.select(
        F.from_csv("line", ddl, {"mode": "PERMISSIVE"}).alias("r"),
        F.col("archive").alias("source_archive"),
        F.col("member").alias("source_member"),
    )
    return parsed.select("r.*", "source_archive", "source_member")


def read_archived_trips(spark: SparkSession, path: str, check_header: bool = False) -> DataFrame:
    """Raw trips straight from a folder (or glob) of ZIP archives.

    With ``check_header`` a member whose first line is not the raw schema's column
    list fails the job.
    """
    if can_open(path):
        _source(spark)
        reader = spark.read.format("trip_archives")
        blocks = (reader.option("header", _header(True)) if check_header else reader).load(path)
        return parse_trip_lines(block_lines(blocks))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return parse_trip_lines(archive_lines(files, check_header=check_header))


def write_archived_trips(raw: DataFrame, path: str) -> None:
    """Raw rows as ZIP archives of CSV files with header, one for each partition of ``raw``."""
    _source(raw.sparkSession)
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines = raw.select(F.to_csv(F.struct(*schema.RAW_COLUMNS), options).alias("line"))
    lines.write.format("trip_archives").mode("append").option("header", _header(True)).save(path)
