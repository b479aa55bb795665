"""Raw zone: monthly trip CSV files read with the declared schema."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dockflow import schema

DEFAULT_FILE_PATTERN = "{month}-*.csv*"  # plain or compressed (.csv.gz, .csv.bz2)
CSV_FILES = "*.{csv,csv.gz,csv.bz2,csv.zst,csv.deflate}"  # what Spark reads by itself, not .csv.zip


def month_paths(raw_dir: str, months: Iterable[str], pattern: str = DEFAULT_FILE_PATTERN) -> list[str]:
    """Glob per month (``yyyyMM``), in the given order; shorten the list for a smoke run."""
    months = list(months)
    if not months:
        raise ValueError("no months selected")
    return [os.path.join(raw_dir, pattern.format(month=m)) for m in months]


def read_raw_trips(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    check_header: bool = False,
    glob_filter: str | None = CSV_FILES,
    recursive: bool = False,
) -> DataFrame:
    """Read raw trip CSVs as one table with ``schema.RAW_SCHEMA``.

    No schema inference (no extra pass). PERMISSIVE mode: an unparsable number
    becomes NULL, an empty field (quoted or not) becomes NULL. Columns bind by
    position unless ``check_header`` is set, which validates the header names
    against the schema. ``glob_filter`` keeps only CSV files (plain or
    compressed; Spark decompresses by extension, a gzip file is one task) when
    a folder also holds ZIP archives.
    """
    reader = (
        spark.read.schema(schema.RAW_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not check_header)
    )
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


LINE = "_corrupt_record"
TOO_FEW, TOO_MANY, NOT_A_NUMBER = "too few fields", "too many fields", "not a number: "


def read_raw_with_quarantine(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    header: bool = True,
    glob_filter: str | None = CSV_FILES,
    recursive: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Raw trips of the well-formed lines, and the other lines: ``(ride_id, line, file, reason)``.

    A line is malformed if it has too few or too many fields for ``RAW_SCHEMA``, or
    text that is no number where one belongs (the first such column is named); an
    empty field is well-formed and null. Both tables come from the same scan
    options; each reads the files once when it is used, and neither needs a shuffle.
    Empty lines are no lines; an empty folder of files gives two empty tables.
    """
    kind = StructType([*schema.RAW_SCHEMA.fields, StructField(LINE, StringType())])
    reader = spark.read.schema(kind).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
    reader = reader.option("columnPruning", False)  # a line is judged whole, whatever columns are used
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    rows = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    # Spark converts only the columns in use and judges a line by these, so both filters name all numbers.
    numbers = [F.col(f.name).cast("string") for f in schema.RAW_SCHEMA.fields if f.dataType != StringType()]
    malformed = F.col(LINE).isNotNull() | (F.concat_ws("", *numbers) == "no number")
    good = rows.where(~malformed).select(*schema.RAW_COLUMNS)
    bad = rows.where(malformed).select("ride_id", F.col(LINE).alias("line"), F.col("_metadata.file_path").alias("file"))
    return good, bad.select("ride_id", "line", "file", _reason(F.col("line")).alias("reason"))


def _reason(line):
    """Why a line is no raw row, by parsing it once more as text only, with one field to spare."""
    names = [f"`{c}` string" for c in schema.RAW_COLUMNS]
    exact = F.from_csv(line, ", ".join([*names, f"{LINE} string"]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE})
    longer = F.from_csv(line, ", ".join([*names, "`_more` string", f"{LINE} string"]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE})
    wrong_count = exact[LINE].isNotNull()
    enough = longer[LINE].isNull() | longer["_more"].isNotNull()
    reason = F.when(wrong_count & enough, TOO_MANY).when(wrong_count, TOO_FEW)
    for f in schema.RAW_SCHEMA.fields:
        if f.dataType != StringType():
            reason = reason.when(exact[f.name].isNotNull() & exact[f.name].try_cast(f.dataType).isNull(), NOT_A_NUMBER + f.name)
    return reason.otherwise("malformed")


def write_raw_trips(raw: DataFrame, uri: str, mode: str = "overwrite") -> None:
    """Publish raw rows as CSV with header (a row-level copy of the raw zone).

    The CSV writer trims values by default; raw text is kept byte for byte so
    that cleaning the published copy gives the same result.
    """
    (
        raw.select(*schema.RAW_COLUMNS)
        .write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(uri)
    )
