"""ZIP archives of trip files as a Spark data source, ``trip_archives``.

Reading: one partition for each archive, which is opened where it lies (any path
:mod:`pyarrow.fs` opens: local and shared folders, HDFS, S3, GCS) and inflated in
blocks of a fixed size, so an archive of any size needs the same memory and is
fetched only as far as its directory and its trip file reach. Rows are the blocks of
:data:`BLOCK_SCHEMA`; lines are split and parsed in the JVM.

Writing: each task writes an archive aside, with one trip file; they get their names
when all tasks are done.
"""

from __future__ import annotations

import fnmatch
import os
import posixpath
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

BLOCK_SCHEMA = "archive string, member string, first_line long, text string"
BLOCK_BYTES = 4 << 20
#: Schemes that pyarrow opens, by the names Hadoop uses for them.
SCHEMES = {"": "", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs"}


def is_trip_file(entry: zipfile.ZipInfo) -> bool:
    """A CSV file that is no macOS by-product: those lie in a ``__MACOSX`` folder or are ``._`` files."""
    path = PurePosixPath(entry.filename)
    return not entry.is_dir() and path.suffix.lower() == ".csv" and "__MACOSX" not in path.parent.parts and not path.name.startswith("._")


def pick_csv_member(entries: list[zipfile.ZipInfo]) -> zipfile.ZipInfo | None:
    """The first trip file of an archive."""
    return next(filter(is_trip_file, entries), None)


def text_blocks(path: str, opened, expected_header: str | None = None) -> Iterator[pa.RecordBatch]:
    """An archive's trip file in blocks of about ``BLOCK_BYTES``, cut after a line end."""
    with zipfile.ZipFile(opened) as zf:
        member = pick_csv_member(zf.infolist())
        if member is None:
            raise ValueError(f"no CSV member inside {path}")
        name, line, rest = PurePosixPath(member.filename).name, 0, b""
        with zf.open(member) as fh:
            while data := fh.read(BLOCK_BYTES):
                data = rest + data
                cut = data.rfind(b"\n") + 1
                block, rest = data[:cut], data[cut:]
                if block:
                    _check_header(block, line, path, expected_header)
                    yield _block(path, name, line, block)
                    line += block.count(b"\n")
        if rest:
            _check_header(rest, line, path, expected_header)
            yield _block(path, name, line, rest)


def _check_header(block: bytes, line: int, path: str, expected: str | None) -> None:
    if line == 0 and expected is not None:
        first = block.split(b"\n", 1)[0].rstrip(b"\r").decode(errors="replace")
        if first.lstrip("\ufeff") != expected:
            raise ValueError(f"unexpected CSV header in {path}: {first[:200]!r}")


def _block(path: str, member: str, line: int, block: bytes) -> pa.RecordBatch:
    text = block.removesuffix(b"\n").decode(errors="replace")
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([member]), pa.array([line]), pa.array([text])], ["archive", "member", "first_line", "text"])


def can_open(path: str) -> bool:
    return path.partition("://")[0] in SCHEMES if "://" in path else ":/" not in path or path.startswith("file:/")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop-style path, and the path in it."""
    if path.startswith("file:/") and "://" not in path:  # as Hadoop writes local paths
        path = "file://" + path[len("file:"):]
    scheme, sep, rest = path.partition("://")
    if not sep:
        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{rest}")


def list_archives(path: str) -> list[str]:
    """Archives at ``path``: a folder, one archive, or a folder with a name pattern."""
    system, inner = file_system(path)
    folder, pattern = inner.rstrip("/"), "*.zip"
    if any(c in posixpath.basename(folder) for c in "*?["):
        folder, pattern = posixpath.split(folder)
    found = system.get_file_info(folder)
    if found.type == fs.FileType.File:
        return [path]
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no archives at {path}")
    prefix = path[: path.rindex(folder)] if folder in path else ""
    files = system.get_file_info(fs.FileSelector(folder))
    return sorted(prefix + f.path for f in files if f.is_file and fnmatch.fnmatch(f.base_name, pattern) and f.base_name.endswith(".zip"))


@dataclass
class Archive(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    aside: str
    final: str


class TripArchives(DataSource):
    """``spark.read.format("trip_archives").load(path)`` and ``df.write.format("trip_archives").save(path)``.

    Options: ``header`` (the first line that is expected; else none is checked),
    ``paths`` (archives, one a line, instead of a path).
    """

    @classmethod
    def name(cls) -> str:
        return "trip_archives"

    def schema(self) -> str:
        return BLOCK_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ArchiveWriter(dict(self.options), schema.fieldNames())


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.header, self.paths = options.get("path"), options.get("header"), options.get("paths")

    def partitions(self) -> list[InputPartition]:
        found = [p for p in self.paths.split("\n") if p] if self.paths is not None else list_archives(self.path)
        return [Archive(p) for p in found]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archive at all
            return
        system, inner = file_system(partition.path)
        with system.open_input_file(inner) as opened:
            yield from text_blocks(partition.path, opened, self.header)


class ArchiveWriter(DataSourceArrowWriter):
    """Lines (one string column, the header line first in each file) into one archive for each task."""

    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.header = options["path"], options.get("header")
        if len(names) != 1:
            raise ValueError(f"one column of lines is written, not {names}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written | None:
        from pyspark import TaskContext

        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        part = f"part-{TaskContext.get().partitionId():05d}"
        aside, final = f"{folder}/_{part}-{os.urandom(4).hex()}.tmp", f"{folder}/{part}.zip"
        with system.open_output_stream(aside) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf, zf.open(f"{part}.csv", "w", force_zip64=True) as fh:
            if self.header:
                fh.write(self.header.encode() + b"\n")
            for batch in iterator:
                fh.write("".join(f"{line}\n" for line in batch.column(0).to_pylist() if line is not None).encode(errors="surrogatepass"))
        return Written(aside, final)

    def commit(self, messages: list[Written | None]) -> None:
        system, _ = file_system(self.path)
        for m in filter(None, messages):
            system.move(m.aside, m.final)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = file_system(self.path)
        for m in filter(None, messages):
            system.delete_file(m.aside)
