"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are scaled to unit length and rotated so that leading dimensions carry
most of their length. Rows of one label are cut into tiles along the first
dimension; pairs of tiles whose boxes lie too far apart are never met. Inside a
pair of tiles inner products grow by blocks of leading dimensions; the rest is
bounded by the product of the suffix norms, and pairs that can't reach the
threshold any more are dropped after each block. What survives is decided on
the given numbers in double precision. Every tile pair returns link counts and a
spanning forest of its links, so that a group of near copies costs rows, not
pairs. Equal vectors are one class with a count from the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.base import map_batches, map_stream, settle
from dockflow.llm.graph import components

TILE = 1024
#: Dimensions added between two tests of the bound.
STEP = 8
#: Dimensions that the rotation covers, and those of a tile's box.
ROTATED, BOX = 256, 8
#: Bounds err by this much at most, so that rounding never drops a pair.
SLACK = 1e-9
TILE_SCHEMA = "part int, seq int, label long, dim int, cids array<long>, sizes array<long>, vectors binary, low array<double>, high array<double>"


def _usable(v: Column) -> Column:
    return F.coalesce(
        (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim) if pa.types.is_binary(column.type) else np.array(column.to_pylist(), float).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(classes: DataFrame, dim: int) -> np.ndarray:
    """Principal axes of the unit vectors of ``dim`` numbers, over their first ``ROTATED`` ones."""
    p = min(dim, ROTATED)
    i, j = np.triu_indices(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = np.zeros((p, p))
        for b in batches:
            x = _unit(_matrix(b.column(0), dim))[:, :p]
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "c"])

    rows = map_stream(classes.where(F.col("dim") == dim).select("v"), run, "i int, j int, c double").groupBy("i", "j").agg(F.sum("c").alias("c")).collect()
    gram = np.zeros((p, p))
    for r in rows:
        gram[r.i, r.j] = gram[r.j, r.i] = r.c
    _, axes = np.linalg.eigh(gram)
    return np.ascontiguousarray(axes[:, ::-1])


def _rotate(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    p = len(axes)
    return np.concatenate([x[:, :p] @ axes, x[:, p:]], axis=1)


def near_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of ``a`` and ``b`` with cosine >= ``threshold``; ``same``: of one tile, each pair once."""
    x, y = _rotate(_unit(a), axes), _rotate(_unit(b), axes)
    dim, bound = x.shape[1], threshold - SLACK
    rest = lambda z, k: np.sqrt(np.maximum((z[:, k:] ** 2).sum(axis=1), 0))
    first = min(STEP, dim)
    partial = x[:, :first] @ y[:, :first].T
    left = partial + np.outer(rest(x, first), rest(y, first)) >= bound
    if same:
        left &= np.triu(np.ones(left.shape, bool), 1)
    i, j = np.nonzero(left)
    dot = partial[i, j]
    for k in range(first, dim, STEP):
        if not len(i):
            break
        e = min(k + STEP, dim)
        dot = dot + np.einsum("nd,nd->n", x[i, k:e], y[j, k:e])
        ok = dot + rest(x, e)[i] * rest(y, e)[j] >= bound
        i, j, dot = i[ok], j[ok], dot[ok]
    if not len(i):
        return i, j
    p, q = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    out_i, out_j = [], []
    for s in range(0, len(i), 1 << 16):
        u, v = p[i[s:s + (1 << 16)]], q[j[s:s + (1 << 16)]]
        cos = np.einsum("nd,nd->n", u, v) / (np.sqrt(np.einsum("nd,nd->n", u, u)) * np.sqrt(np.einsum("nd,nd->n", v, v)))
        ok = cos >= threshold
        out_i.append(i[s:s + (1 << 16)][ok])
        out_j.append(j[s:s + (1 << 16)][ok])
    return np.concatenate(out_i), np.concatenate(out_j)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that span what the links ``a``-``b`` connect."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _tiles(axes: dict[int, np.ndarray], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            label, dim = held[0][:2]
            x = np.frombuffer(b"".join(r[4] for r in held), "<f8").reshape(-1, dim)
            y = _rotate(_unit(x), axes[dim])[:, :BOX]
            cells = [[part], [seq], [label], [dim], [[r[2] for r in held]], [[r[3] for r in held]], [x.tobytes()], [y.min(axis=0).tolist()], [y.max(axis=0).tolist()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], ["part", "seq", "label", "dim", "cids", "sizes", "vectors", "low", "high"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "cid", "size", "packed")), strict=True):
                if held and (held[0][:2] != row[:2] or len(held) >= size):
                    yield flush()
                    held, seq = [], seq + 1
                held.append(row)
        if held:
            yield flush()

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row for each row of ``vectors``.

    Vectors of one label that is not null, and of one length, link where their
    cosine reaches ``threshold`` (above 0). Vectors that are null, empty, zero or
    hold a null or non-finite number link with nothing. ``component_id`` is the
    smallest id that links reach; rows that repeat an id each count as a vector.
    Extra columns are not read, no rows give no rows.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("long").alias("label"))
    rows = rows.withColumn("ok", _usable(F.col("v")) & F.col("label").isNotNull())
    classes = settle(
        rows.where("ok").groupBy("label", "v").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
        .select("label", "v", "size", "least", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("cid")), "vector-classes")
    axes = {r.dim: rotation(classes, r.dim) for r in classes.select("dim").distinct().collect()}

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        dims = batch.column("dim").to_numpy()
        first, packed = np.zeros(len(dims)), [b""] * len(dims)
        values = batch.column("v").to_pylist()
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = np.array([values[k] for k in at], float)
            first[at] = _rotate(_unit(x), axes[int(d)])[:, 0]
            for k, row in zip(at, x, strict=True):
                packed[k] = row.tobytes()
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "dim", "cid", "size")), pa.array(first), pa.array(packed, pa.binary())], ["label", "dim", "cid", "size", "first", "packed"])

    placed = settle(map_batches(classes, place, "label long, dim int, cid long, size long, first double, packed binary"), "vector-order")
    order = ["label", "dim", "first", "cid"]
    tiles = settle(map_stream(placed.repartitionByRange(*order).sortWithinPartitions(*order), _tiles(axes, tile), TILE_SCHEMA), "vector-tiles")
    # Tiles of a label are numbered; pairs are met by number, after their boxes.
    boxes = tiles.select("part", "seq", "label", "dim", "low", "high")
    numbered = settle(boxes.withColumn("k", F.row_number().over(Window.partitionBy("label", "dim").orderBy("part", "seq"))), "vector-boxes")
    many = numbered.groupBy("label", "dim").agg(F.max("k").alias("many"))
    asked = numbered.join(many, ["label", "dim"]).select("label", "dim", F.col("k").alias("k1"), "part", "seq", "low", "high", F.explode(F.sequence("k", "many")).alias("k"))
    other = numbered.select("label", "dim", "k", F.col("part").alias("part2"), F.col("seq").alias("seq2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    gaps = F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("low2", "high2"), lambda p, q: F.pow(F.greatest(p["low"] - q["high2"], q["low2"] - p["high"], F.lit(0.0)), 2))
    apart = F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x)
    pairs = asked.join(other, ["label", "dim", "k"]).where(apart <= 2 - 2 * threshold + SLACK).select("part", "seq", "part2", "seq2", "dim")
    left = tiles.select("part", "seq", F.col("cids").alias("c1"), F.col("sizes").alias("n1"), F.col("vectors").alias("v1"))
    right = tiles.select(F.col("part").alias("part2"), F.col("seq").alias("seq2"), F.col("cids").alias("c2"), F.col("sizes").alias("n2"), F.col("vectors").alias("v2"))
    met = pairs.join(left, ["part", "seq"]).join(right, ["part2", "seq2"])
    met = met.select("dim", ((F.col("part") == F.col("part2")) & (F.col("seq") == F.col("seq2"))).alias("same"), "c1", "n1", "v1", "c2", "n2", "v2")

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[np.ndarray] = [np.empty((0, 3), np.int64)]
        for k in range(batch.num_rows):
            dim, same, c1, n1, v1, c2, n2, v2 = (batch.column(c)[k].as_py() for c in range(8))
            a, b = (np.frombuffer(v, "<f8").reshape(-1, dim) for v in (v1, v2))
            i, j = near_pairs(a, b, axes[dim], threshold, same)
            if not len(i):
                continue
            c1, c2 = np.array(c1), np.array(c2)
            # Link counts as (class, -1, count), a spanning forest as (class, class, 0).
            for c, n in ((c1, np.bincount(i, np.array(n2)[j], len(c1))), (c2, np.bincount(j, np.array(n1)[i], len(c2)))):
                at = np.flatnonzero(n)
                out.append(np.stack([c[at], np.full(len(at), -1), n[at].astype(np.int64)], axis=1))
            out.append(np.array([(x, y, 0) for x, y in _forest(c1[i], c2[j])], np.int64).reshape(-1, 3))
        rows = np.concatenate(out)
        return pa.RecordBatch.from_arrays([pa.array(rows[:, c]) for c in range(3)], ["a", "b", "n"])

    found = settle(map_batches(met, compare, "a long, b long, n long"), "vector-links")
    counts = found.where("b = -1").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("near"))
    roots = components(found.where("b >= 0").select("a", "b")).select(F.col("node").alias("cid"), "root")
    known = classes.join(counts, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    answer = known.join(least, "root").select("label", "v", (F.col("size") - 1 + F.coalesce("near", F.lit(0))).alias("n"), "component")
    key = ["label", "v"]
    linked = rows.where("ok").join(answer, key).select("vec_id", F.col("n").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
