"""Documents in compressed chunks, and the arrays that travel between them and shards.

A repeat finder reads the documents several times and sends each chunk answers of
its own; the chunks are written once, bucketed by number, so that none of those
joins moves a text again.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from dockflow.llm.base import map_stream, text_bytes
from dockflow.session import scratch_path

#: Bytes of a chunk of documents (a longer document is one).
CHUNK_BYTES, CHUNK_DOCS = 8 << 20, 8192
LAST = np.int64((1 << 63) - 1)
C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mix(words: list[np.ndarray], salt: int = 0) -> np.ndarray:
    h = np.full(len(words[0]), C[salt], np.uint64)
    for w in words:
        h = (h ^ w) * C[(salt + 1) % 4]
        h ^= h >> np.uint64(29)
    h *= C[(salt + 2) % 4]
    return h ^ (h >> np.uint64(32))


# Arrays travel as zstandard frames; sorted hashes as the byte planes of their differences.

def pack(*arrays: np.ndarray | bytes) -> bytes:
    parts = [x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes() for x in arrays]
    head = np.array([len(parts), *map(len, parts)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", n, 8)
    at, out = 8 * (n + 1), []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, np.dtype(kind), size // np.dtype(kind).itemsize, at))
        at += size
    return out


def planes(values: np.ndarray) -> np.ndarray:
    gaps = np.diff(values, prepend=np.uint64(0)) if len(values) else values
    return np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def from_planes(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(gaps.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def ids_of(cell: list) -> np.ndarray:
    """Ids as they are ordered: null ones after all others."""
    return np.array([LAST if x is None else x for x in cell], np.int64)


def texts_of(row_sizes: list[int], data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    ends = np.cumsum(row_sizes).tolist()
    return [raw[e - n:e] for n, e in zip(row_sizes, ends, strict=True)]


CHUNK_SCHEMA = "chunk long, ids array<long>, sizes array<int>, data binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids: list[int | None] = []
    texts: list[bytes] = []
    size = 0

    def flush() -> pa.RecordBatch:
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        cells = [([number], pa.int64()), ([ids], pa.list_(pa.int64())), ([[len(t) for t in texts]], pa.list_(pa.int32())), ([data], pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in cells], ["chunk", "ids", "sizes", "data"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            if ids and (size + len(text) > CHUNK_BYTES or len(ids) >= CHUNK_DOCS):
                yield flush()
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(doc)
            texts.append(text)
            size += len(text)
    if ids:
        yield flush()


def chunk_table(docs: DataFrame, buckets: int) -> DataFrame:
    """The documents as ``CHUNK_SCHEMA`` rows, written once and bucketed by chunk.

    Only a table can be read as bucketed. Its entry in the session's catalog goes as
    soon as the plan has it; the files are under the checkpoint folder.
    """
    spark = docs.sparkSession
    name = f"dockflow_chunks_{os.urandom(6).hex()}"
    rows = map_stream(docs, _chunks, CHUNK_SCHEMA)
    rows.write.bucketBy(buckets, "chunk").option("path", scratch_path(spark, "chunks")).option("compression", "uncompressed").saveAsTable(name)
    chunks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return chunks


def each_chunk(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list[bytes], list]]:
    for i in range(batch.num_rows):
        row = [batch.column(c)[i].as_py() for c in range(batch.num_columns)]
        yield row[0], ids_of(row[1]), texts_of(row[2], row[3]), row[4:]


def batch_of(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def spread(values: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of equal ranges of hashes."""
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
