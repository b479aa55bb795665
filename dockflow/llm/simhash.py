"""SimHash near-duplicates by generalised pigeonhole search.

Fingerprints: majority bits of the XXH64 of word shingles. Equal fingerprints
are collapsed first, so copies cost nothing further. The 64 bits are dealt into
four partitions that keep correlated bits together; per-partition thresholds
(they may differ, and -1 skips a partition) come from a dynamic program over
candidate counts estimated from the partitions' histograms. Two fingerprints at
distance <= tau then agree within the threshold on one partition at least, so
probing those balls finds every link; each candidate is verified on all bits.
Buckets of many fingerprints are cut into blocks and every pair of blocks is
compared in a task of its own that returns a spanning forest of its links, so
that the output stays linear in the rows read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import free_name, map_batches, map_stream, settle, text_bytes
from dockflow.llm.graph import components

BITS = 64
PARTS = 4
WIDTH = BITS // PARTS
BLOCK = 1024
ROW, ROW_ID, LAST_ID = "row__", "row_id__", (1 << 63) - 1


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits over the shingles of ``text``; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hash_of, join = xxhash.xxh64_intdigest, b" ".join
    sums, step = np.zeros(BITS, np.int64), 1 << 16
    for i in range(0, n, step):
        h = np.array([hash_of(join(words[k:k + shingle]), seed) for k in range(i, min(n, i + step))], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` and the long columns ``extra``: the 64-bit fingerprint as a signed long, a row for each row of ``docs``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], ["doc_id", "fp", *extra])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra)
    return map_batches(rows, run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *extra)))


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(distinct: DataFrame) -> list[list[int]]:
    """Four groups of 16 bits, correlated bits together, from the co-occurrence of all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            x = 2.0 * _bits(batch.column(0).to_numpy(zero_copy_only=False)) - 1
            total += x.T @ x
        i, j = np.triu_indices(BITS, 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "c"])

    pairs = map_stream(distinct.select("fp"), run, "i int, j int, c double").groupBy("i", "j").agg(F.sum("c").alias("c")).collect()
    corr = np.zeros((BITS, BITS))
    for r in pairs:
        corr[r.i, r.j] = corr[r.j, r.i] = abs(r.c)
    left, groups = set(range(BITS)), []
    for _ in range(PARTS):
        free = sorted(left)
        sub = corr[np.ix_(free, free)]
        group = [free[int(np.unravel_index(np.argmax(sub), sub.shape)[0])]]
        left.discard(group[0])
        while len(group) < WIDTH:
            best = max(sorted(left), key=lambda b: corr[b, group].sum())
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def part_key(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group`` packed into a small integer."""
    key = np.zeros(len(fps), np.int64)
    for k, b in enumerate(group):
        key |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return key


def masks(width: int, radius: int) -> np.ndarray:
    """All masks of ``width`` bits with at most ``radius`` set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.int64)


def allocate(histograms: list[np.ndarray], tau: int) -> list[int]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = tau + 1 of the least estimated cost.

    The cost of a threshold is the number of probes plus the number of candidate
    pairs its balls meet, exact for the histograms given.
    """
    size = tau + 1
    cost = []
    for h in histograms:
        h, at, row = h.astype(float), np.arange(len(h)), [0.0]
        for t in range(size):
            m = masks(int(np.log2(len(h))), t)
            row.append(h.sum() * len(m) + sum(float(h @ h[at ^ x]) for x in m))
        cost.append(row)
    best = {0: (0.0, [])}
    for row in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, tau + 1):
                u = used + t + 1
                if u <= size and (u not in nxt or c + row[t + 1] < nxt[u][0]):
                    nxt[u] = (c + row[t + 1], [*ts, t])
        best = nxt
    return best[size][1]


def _forest(fps: np.ndarray, exact: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of one bucket block, as (member, root)."""
    u, at = np.unique(fps, return_inverse=True)
    ex = np.zeros(len(u), bool)
    ex[at[exact]] = True
    near = np.bitwise_count(u[ex][:, None] ^ u[None, :]) <= tau
    full = np.zeros((len(u), len(u)), bool)
    full[ex] = near
    full |= full.T
    np.fill_diagonal(full, False)
    todo, out = full.any(axis=1), []
    for root in np.flatnonzero(todo):
        if not todo[root]:
            continue
        todo[root] = False
        front = np.array([root])
        while len(front):
            new = full[front].any(axis=0) & todo
            todo &= ~new
            front = np.flatnonzero(new)
            out += [(int(u[x]), int(u[root])) for x in front]
    return out


def _small_pairs(gid: np.ndarray, fps: np.ndarray, exact: np.ndarray, tau: int) -> list[np.ndarray]:
    """Verified pairs inside the groups of few rows, one shift at a time."""
    out = [np.empty((0, 2), np.uint64)]
    for s in range(1, len(gid)):
        same = gid[s:] == gid[:-s]
        if not same.any():
            break
        i = np.flatnonzero(same & (exact[s:] | exact[:-s]))
        i = i[(np.bitwise_count(fps[i] ^ fps[i + s]) <= tau) & (fps[i] != fps[i + s])]
        out.append(np.stack([fps[i], fps[i + s]], axis=1))
    return out


def _compare(tau: int):
    cols = ["part", "key", "b1", "b2"]

    def work(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        k = [t.column(c).to_numpy() for c in cols]
        fps, exact = t.column("fp").to_numpy().view(np.uint64), t.column("exact").to_numpy(zero_copy_only=False)
        new = np.ones(len(fps), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in k])
        starts = np.append(np.flatnonzero(new), len(fps))
        sizes = np.diff(starts)
        few = np.repeat((sizes > 1) & (sizes <= 48), sizes)
        found = _small_pairs(np.repeat(np.arange(len(sizes)), sizes)[few], fps[few], exact[few], tau)
        for g in np.flatnonzero(sizes > 48):
            s = slice(starts[g], starts[g + 1])
            forest = _forest(fps[s], exact[s], tau)
            if forest:
                found.append(np.array(forest, np.uint64))
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            k = [batch.column(c).to_numpy() for c in cols]
            other = np.flatnonzero(np.logical_or.reduce([x != x[-1] for x in k]))
            cut = int(other[-1]) + 1 if len(other) else 0  # rows before the last group
            if cut:
                yield work([*held, batch.slice(0, cut)])
                held = []
            elif held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in cols):
                yield work(held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield work(held)

    return run


def links(distinct: DataFrame, tau: int = 3, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links that connect all distinct fingerprints (column ``fp``) within ``tau`` bits.

    Not every pair is listed: inside a large bucket a spanning forest stands for
    its pairs. Their closure is that of all pairs at distance <= tau.
    """
    spark = distinct.sparkSession
    groups = bit_groups(distinct)

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(PARTS, dtype=np.int32), len(fps))), pa.array(np.concatenate([part_key(fps, g) for g in groups]))], ["part", "key"])

    # At most PARTS * 2**WIDTH rows, whatever the size of the corpus.
    counts = map_batches(distinct.select("fp"), keys, "part int, key long").groupBy("part", "key").count().toPandas()
    histograms = [np.zeros(1 << WIDTH, np.int64) for _ in groups]
    for p in range(PARTS):
        own = counts[counts.part == p]
        histograms[p][own.key.to_numpy()] = own["count"].to_numpy()
    limits = allocate(histograms, tau)
    balls = [masks(WIDTH, t) if t >= 0 else np.empty(0, np.int64) for t in limits]

    def probes(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        part, key, fp, exact = [], [], [], []
        for p, ball in enumerate(balls):
            own = part_key(fps, groups[p])
            for m in ball:
                part.append(np.full(len(fps), p, np.int32))
                key.append(own ^ m)
                fp.append(fps.view(np.int64))
                exact.append(np.full(len(fps), m == 0))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (part, key, fp, exact)], ["part", "key", "fp", "exact"])

    rows = map_batches(distinct.select("fp"), probes, "part int, key long, fp long, exact boolean")
    hot = []
    for p, ball in enumerate(balls):
        met = sum((histograms[p][np.arange(1 << WIDTH) ^ m] for m in ball), np.zeros(1 << WIDTH, np.int64))
        hot += [(p, int(k), int(-(-met[k] // block))) for k in np.flatnonzero(met > block)]
    blocks = spark.createDataFrame(hot, "part int, key long, n int")  # bounded like the histograms
    n = F.coalesce("n", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), n.cast("long")).cast("int")
    dealt = (
        rows.join(F.broadcast(blocks), ["part", "key"], "left")
        .select("part", "key", "fp", "exact", own.alias("own"), F.explode(F.sequence(F.lit(0), n - 1)).alias("other"))
        .select("part", "key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "fp", "exact")
    )
    sides = ["part", "key", "b1", "b2"]
    ready = dealt.repartition(*sides).sortWithinPartitions(*sides)
    return map_stream(ready, _compare(tau), "a long, b long").distinct()


def _classes(fps: DataFrame, tau: int) -> DataFrame:
    """``(fp, component_id)`` of the fingerprints of ``fps`` (doc_id, fp)."""
    distinct = settle(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = components(links(distinct, tau)).select(F.col("node").alias("fp"), "root")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, tau: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)``, a row for each row of ``docs``.

    Documents whose fingerprints differ in ``tau`` bits or fewer are linked;
    ``component_id`` is the smallest id that links reach (null ids don't count as
    smallest; a component of nulls only has none). Null and empty texts, and
    those of white space, have fingerprint zero and link like any other; texts
    of fewer than ``shingle`` words are one shingle. Repeated rows link to each
    other. No rows give no rows; extra columns are not read.
    """
    fps = settle(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return fps.join(_classes(fps, tau), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, tau: int = 3) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all columns as they are.

    The row of least id stays; of rows that repeat this id, the one of least
    content hash, and one of equal rows. Rows without an id come last; without
    any id, those of one fingerprint are a group. Texts are treated as in
    ``near_duplicates``.
    """
    row, own_id = free_name(docs, ROW), free_name(docs, ROW_ID)
    whole = docs.withColumn(row, F.xxhash64(*docs.columns)).withColumn(own_id, F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)))
    narrow = settle(fingerprints(whole, id_col, text_col, shingle, (row, own_id)), "row-fingerprints")
    group = F.coalesce("component_id", F.xxhash64("fp", F.lit(1)))
    first = narrow.join(_classes(narrow, tau), "fp").groupBy(group, F.col("component_id").isNull()).agg(F.min(F.struct(own_id, row)).alias("m"))
    # The join deals rows by their key, which dropping repeats of one row then uses again.
    return whole.join(first.select(f"m.{own_id}", f"m.{row}"), [own_id, row]).dropDuplicates([own_id, row]).select(*docs.columns)
