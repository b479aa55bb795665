"""Product-quantised codes of vectors, nearest codebook entries by Orchard's search.

A vector's components become integers and are cut into ``PARTS`` consecutive
parts; each part position has a codebook of ``ENTRIES`` entries. A round assigns
every part to its nearest entry and moves each entry to the mean of its parts.

Nearest entries are found by Orchard's search. Every entry keeps the others in a
list sorted by distance. A part starts at an entry and walks that entry's list;
an entry that is nearer takes over, and the walk goes on in its list. Entries
seen are marked and not measured again. The walk stops where the list is further
away than twice the current distance: by the triangle inequality nothing behind it
can be nearer. At exactly twice an entry can be as near, so it is measured too,
and of equally near ones the lower index stays.

All arithmetic is in integers, so sums don't depend on their order. A round is one
pass over the integer vectors, written once under the checkpoint folder; a task
emits at most ``PARTS x ENTRIES`` rows of partial sums and the driver gets the
codebooks' sums only, whose size doesn't depend on the number of vectors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import map_batches, map_stream, settle

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components are held within these bounds, so that errors fit 64 bits for some 100 dimensions.
LARGEST = 1 << 27
#: Parts searched at once.
BLOCK = 1 << 15


def edges_of(dims: int, parts: int = PARTS) -> list[int]:
    """Bounds of the consecutive parts; if ``dims`` can't be cut evenly, the first parts are one longer."""
    return [0, *np.cumsum([dims // parts + (p < dims % parts) for p in range(parts)]).tolist()]


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry all entries by distance from it, and those squared distances."""
    gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    order = np.argsort(gaps, axis=1, kind="stable")
    return order, np.take_along_axis(gaps, order, axis=1)


def orchard(points: np.ndarray, book: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point and its squared distance; of equally near entries the least."""
    order, gaps = neighbour_lists(book)
    n, k = len(points), len(book)
    best = np.zeros(n, np.int64) if start is None else start.astype(np.int64)
    near = ((points - book[best]) ** 2).sum(axis=1)
    seen = np.zeros((n, k), bool)
    seen[np.arange(n), best] = True
    place = np.zeros(n, np.int64)
    walking = np.arange(n)
    while len(walking):
        cur, at = best[walking], place[walking]
        more = at < k
        walking, cur, at = walking[more], cur[more], at[more]
        go = gaps[cur, at] <= 4 * near[walking]  # squares of the distance and of twice the current one
        walking, cur, at = walking[go], cur[go], at[go]
        other = order[cur, at]
        place[walking] = at + 1
        new = ~seen[walking, other]
        who, entry = walking[new], other[new]
        seen[who, entry] = True
        d = ((points[who] - book[entry]) ** 2).sum(axis=1)
        better = (d < near[who]) | ((d == near[who]) & (entry < best[who]))
        who = who[better]
        best[who], near[who], place[who] = entry[better], d[better], 0
    return best, near


def _assign(vectors: np.ndarray, books: list[np.ndarray], edges: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each vector's parts, and the summed squared distances."""
    codes, error = np.empty((len(vectors), len(books)), np.int64), np.zeros(len(vectors), np.int64)
    for a in range(0, len(vectors), BLOCK):
        some = vectors[a:a + BLOCK]
        for p, book in enumerate(books):
            best, near = orchard(some[:, edges[p]:edges[p + 1]], book)
            codes[a:a + BLOCK, p] = best
            error[a:a + BLOCK] += near
    return codes, error


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, x array<long>)``: ``floor(scale * component)`` of the vectors without null or non-finite components."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = lambda e: F.floor(F.greatest(F.least(e * F.lit(float(scale)), F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("long")
    kept = vectors.where(v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.transform(v, whole).alias("x"))


def _round(rows: DataFrame, books: list[np.ndarray], edges: list[int]) -> list[np.ndarray]:
    """The codebooks moved to the floored means of their parts; unused entries stay."""
    widths = [b.shape[1] for b in books]

    def run(batches):
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros_like(b) for b in books]
        for batch in batches:
            x = _matrix(batch.column(0), edges[-1])
            codes, _ = _assign(x, books, edges)
            for p in range(len(books)):
                own = codes[:, p]
                order = np.argsort(own, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(own[order]) != 0))
                entries = own[order][first]
                counts[p][entries] += np.diff(np.append(first, len(own)))
                if widths[p]:
                    sums[p][entries] += np.add.reduceat(x[order, edges[p]:edges[p + 1]], first, axis=0)
        part, entry, at, total = [], [], [], []
        for p in range(len(books)):
            for e in np.flatnonzero(counts[p]).tolist():
                values = [int(counts[p][e]), *sums[p][e].tolist()]
                part += [p] * len(values)
                entry += [e] * len(values)
                at += range(-1, len(values) - 1)
                total += values
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(at, pa.int32()), pa.array(total, pa.int64())], ["part", "entry", "at", "total"])

    partial = map_stream(rows.select("x"), run, "part int, entry int, at int, total long")
    found = partial.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect()  # the codebooks' components and counts
    total = {(r.part, r.entry, r.at): r.total for r in found}
    out = []
    for p, book in enumerate(books):
        moved = book.copy()
        for e in range(len(book)):
            if n := total.get((p, e, -1)):
                moved[e] = [total[p, e, j] // n for j in range(widths[p])]
        out.append(moved)
    return out


def train_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[np.ndarray], int]:
    """Codebooks of :func:`integer_vectors` rows, from all of them, and the dimension; none without rows.

    A codebook starts as its part of the ``entries`` vectors of least id (then of
    least components, nulls last); with fewer vectors it has fewer entries.
    """
    order = [F.col("vec_id").asc_nulls_last(), "x"]
    least = rows.orderBy(*order).limit(1).collect()
    if not least:
        return [], 0
    dims = len(least[0].x)
    rows = rows.where(F.size("x") == dims)
    first = rows.orderBy(*order).limit(entries).collect()
    first = np.array([r.x for r in first], np.int64).reshape(len(first), dims)
    edges = edges_of(dims, parts)
    books = [first[:, a:b].copy() for a, b in zip(edges, edges[1:])]
    for _ in range(rounds):
        books = _round(rows, books, edges)
    return books, dims


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, between commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame, books: list[np.ndarray], dims: int) -> DataFrame:
    """``(vec_id, label, codes binary, error)``: a byte for each part, and the summed squared distances."""
    edges = edges_of(dims, len(books)) if books else [0]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, error = _assign(_matrix(batch.column(2), dims), books, edges)
        packed = [r.tobytes() for r in codes.astype(np.uint8)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(error)], ["vec_id", "label", "codes", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return map_batches(rows.where(F.size("x") == dims).select("vec_id", "label", "x"), run, f"vec_id long, label {label}, codes binary, error long")


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, label, codes, error, label_error, codebooks_sha256)``, a row for each vector kept.

    Vectors that are null or hold null or non-finite components are left out; so
    are those of another length than the vector of least id, since no codebook
    fits them. A component beyond ``LARGEST`` after scaling counts as that. Empty
    vectors get codes of zeros. Ties go to the lower index; repeated rows and ids
    are vectors of their own. Labels may have any type, null ones are one label.
    Extra columns are not read; an empty table gives an empty result.
    """
    rows = settle(integer_vectors(vectors, id_col, vector_col, label_col), "integer-vectors")
    books, dims = train_codebooks(rows)
    coded = settle(compress(rows, books, dims), "vector-codes")
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    both = coded.join(per_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return both.withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))
