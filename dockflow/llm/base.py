"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dockflow.session import settled as settle  # noqa: F401  a written table outlives lost executors
from dockflow.session import ship

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any path a Spark reader can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` and some underscores: no column's name in ``df`` whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _release() -> None:
    """Hand memory that a task has freed back to the system: idle workers would keep it from the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``fn`` on each Arrow batch, inside the tasks."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
            del batch, out
        _release()

    return df.mapInArrow(run, schema)


def map_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` on the stream of Arrow batches of each partition."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        yield from fn(batches)
        _release()

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, so that extra columns can't clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The groups of a stream that is sorted by ``keys``, whatever the batches' ends."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        rows = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        at = 0
        for i, key in enumerate(rows):
            if key != last:
                if i > at:
                    held.append(batch.slice(at, i - at))
                if held:
                    yield last, pa.Table.from_batches(held)
                held, last, at = [], key, i
        if len(rows) > at:
            held.append(batch.slice(at))
    if held:
        yield last, pa.Table.from_batches(held)
