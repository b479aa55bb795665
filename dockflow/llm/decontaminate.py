"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are a stated query set that is held against all documents in blocks
of bounded size. Per block one pass counts the items' word n-grams over all
documents. A second pass finds all grams of the items in every document and
gathers those of one item on nearby diagonals into a passage. A passage with a gram
that is rare in the corpus is aligned with the item word by word; one of common
grams alone is, unless it shares too few words with the item to reach the threshold
whatever their order, so that nothing is lost by a gram's being common. All of it
happens where the document is read, so a passage that many documents share makes
no hot key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from dockflow.llm.base import free_name, map_batches, map_stream

N = 3
#: Share of an item's perfect alignment score from which a passage counts as a copy.
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Items are compared in blocks of about so many bytes.
BLOCK_BYTES = 8 << 20
#: An n-gram is rare if it occurs no more often than so many times, or in this share of the documents.
RARE_COUNT, RARE_SHARE = 16, 0.0005
JOB_CELLS = 1 << 19
#: Words of passages whose bounds are taken at a time.
BOUND_WORDS = 1 << 20
#: ASCII letters in lower case, digits, and other bytes of UTF-8 letters are words; the rest parts them.
PARTS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words between ASCII punctuation and white space."""
    return (text or "").lower().encode(errors="surrogatepass").translate(PARTS).split()


def _gram_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """One hash per run of ``n`` word ids; 0 where a word is no word of any item (id 0)."""
    m = len(ids) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(m, np.uint64)
    known = np.ones(m, bool)
    for k in range(n):
        w = ids[k:k + m]
        h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        known &= w != 0
    return np.where(known, h | np.uint64(1), np.uint64(0))


@dataclass
class Items:
    """One block of test items, as it goes with the tasks."""

    ids: list[int | None]
    tokens: list[np.ndarray]
    vocabulary: dict[bytes, int]
    lengths: list[int]  # the gram lengths in use: N, and shorter ones of shorter items
    grams: dict[int, np.ndarray]  # length -> sorted distinct hashes
    posts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] | None = None
    bag: tuple[np.ndarray, np.ndarray] | None = None  # item and word in one number, sorted, and the word's count in the item

    @classmethod
    def build(cls, rows: list[tuple[int | None, str | None]], n: int = N) -> Items:
        vocabulary: dict[bytes, int] = {}
        ids, tokens = [], []
        for i, text in rows:
            w = words_of(text)
            if w:
                ids.append(i)
                tokens.append(np.array([vocabulary.setdefault(x, len(vocabulary) + 1) for x in w], np.uint64))
        lengths = sorted({min(n, len(t)) for t in tokens})
        grams = {k: np.unique(np.concatenate([_gram_hashes(t, k) for t in tokens if min(n, len(t)) == k])) for k in lengths}
        pairs = [np.uint64(i << 32) | t for i, t in enumerate(tokens)]
        return cls(ids, tokens, vocabulary, lengths, grams, bag=np.unique(np.concatenate(pairs), return_counts=True) if pairs else None)

    def doc_ids(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in words_of(text)], np.uint64)

    def hits(self, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in a document and the numbers of the grams there."""
        h = _gram_hashes(ids, k)
        at = np.flatnonzero(h)
        own = self.grams[k]
        no = np.minimum(np.searchsorted(own, h[at]), len(own) - 1)
        ok = own[no] == h[at]
        return at[ok], no[ok]

    def choose_seeds(self, counts: dict[int, np.ndarray], docs: int, n: int = N) -> None:
        """Posting lists by gram; rare are those in few places, and those no more frequent than their item's median one."""
        rare = max(RARE_COUNT, RARE_SHARE * docs)
        post: dict[int, list[tuple[int, int, int, bool]]] = {k: [] for k in self.lengths}
        for i, t in enumerate(self.tokens):
            k = min(n, len(t))
            no = np.searchsorted(self.grams[k], _gram_hashes(t, k))
            c = counts[k][no]
            post[k] += zip(no.tolist(), [i] * len(no), range(len(no)), (c <= max(rare, np.median(c))).tolist(), strict=True)
        self.posts = []
        for k in self.lengths:
            rows = np.array(sorted(post[k]), np.int64).reshape(-1, 4)
            start = np.searchsorted(rows[:, 0], np.arange(len(self.grams[k]) + 1))
            self.posts.append((start, rows[:, 1], rows[:, 2], rows[:, 3]))

    def passages(self, ids: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int, int]]:
        """``(item, from, to)``: parts of a document around grams of an item that can hold an alignment of ``threshold``."""
        found = []
        for k, (start, item, place, rare) in zip(self.lengths, self.posts or [], strict=True):
            at, no = self.hits(ids, k)
            many = start[no + 1] - start[no]
            if not many.sum():
                continue
            rows = np.repeat(start[no], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found.append(np.stack([item[rows], np.repeat(at, many) - place[rows], rare[rows]], axis=1))
        if not found:
            return []
        hits = np.unique(np.concatenate(found), axis=0)
        size = np.array([len(t) for t in self.tokens])[hits[:, 0]]
        # Words matched score MATCH each and every gap costs, so an alignment of enough score leaves a diagonal by no more than this.
        slack = np.floor((1 - threshold) * MATCH * size / -GAP).astype(np.int64)
        new = np.ones(len(hits), bool)
        new[1:] = (hits[1:, 0] != hits[:-1, 0]) | (np.diff(hits[:, 1]) > size[1:] + 2 * slack[1:])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hits)) - 1
        item, m, slack = hits[first, 0], size[first], slack[first]
        a, b = np.maximum(0, hits[first, 1] - slack), np.minimum(len(ids), hits[last, 1] + m + slack)
        ok = np.maximum.reduceat(hits[:, 2], first) > 0
        common = np.flatnonzero(~ok)
        ok[common] = self.most_matches(ids, item[common], a[common], b[common]) >= threshold * m[common]
        return list(zip(item[ok].tolist(), a[ok].tolist(), b[ok].tolist(), strict=True))

    def most_matches(self, ids: np.ndarray, item: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that item and passage share, repeats counted: no alignment can match more of them."""
        out = np.zeros(len(item), np.int64)
        whole = np.cumsum(b - a)
        for part in np.split(np.arange(len(item)), np.flatnonzero(np.diff(whole // BOUND_WORDS)) + 1):
            if not len(part):
                continue
            n = b[part] - a[part]
            who = np.repeat(part, n)
            word = ids[np.repeat(a[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            pairs, c = np.unique(who[word != 0].astype(np.uint64) << np.uint64(32) | word[word != 0], return_counts=True)
            who = (pairs >> np.uint64(32)).astype(np.int64)
            asked = item[who].astype(np.uint64) << np.uint64(32) | (pairs & np.uint64(0xFFFFFFFF))
            own, of = self.bag
            at = np.minimum(np.searchsorted(own, asked), len(own) - 1)
            np.add.at(out, who, np.where(own[at] == asked, np.minimum(c, of[at]), 0))
        return out


def align(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    """Smith-Waterman with linear gaps: ``(score, from, to)`` in words of the second of each pair.

    Word 0 matches nothing. All pairs of one call advance together, a word of the
    passages at a time; the start of each path rides in the low bits of its score.
    """
    m, n = max(len(a) for a, _ in pairs), max(len(b) for _, b in pairs)
    x, y = np.full((len(pairs), m), -1, np.int64), np.full((len(pairs), n), -2, np.int64)
    for r, (a, b) in enumerate(pairs):
        x[r, : len(a)] = a
        y[r, : len(b)] = np.where(b == 0, -2, b.astype(np.int64))
    low = np.int64(1) << 32
    slope = -GAP * low * np.arange(m)
    prev = np.zeros((len(pairs), m), np.int64)
    best, end = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    for j in range(n):
        diag = np.full_like(prev, j)
        diag[:, 1:] = np.maximum(prev[:, :-1], j)
        now = diag + np.where(x == y[:, j:j + 1], MATCH, MISMATCH) * low
        now = np.maximum(np.maximum(now, prev + GAP * low), j + 1)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        top = now.max(axis=1)
        more = (top >> 32) > (best >> 32)
        best, end = np.where(more, top, best), np.where(more, j + 1, end)
        prev = now
    return list(zip((best >> 32).tolist(), (best & (low - 1)).tolist(), end.tolist(), strict=True))


def _align_all(items: Items, jobs: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int, int]]:
    """Alignments of (row, item, passage) jobs, those of like size together."""
    order = sorted(range(len(jobs)), key=lambda k: (len(items.tokens[jobs[k][1]]), len(jobs[k][2])))
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(jobs)
    some: list[int] = []

    def flush() -> None:
        for k, r in zip(some, align([(items.tokens[jobs[k][1]].astype(np.int64), jobs[k][2]) for k in some]), strict=True):
            out[k] = r

    cells = wide = 0
    for k in order:
        m = len(items.tokens[jobs[k][1]])
        wide = max(wide, len(jobs[k][2]))
        if some and (cells + m > JOB_CELLS // 8 or (len(some) + 1) * wide > JOB_CELLS):
            flush()
            some, cells, wide = [], 0, len(jobs[k][2])
        some.append(k)
        cells += m
    if some:
        flush()
    return out


HIT = StructType([StructField("item_id", LongType()), StructField("score", DoubleType()), StructField("first_word", LongType()), StructField("end_word", LongType())])


def _count_grams(docs: DataFrame, items: Items, text_col: str) -> tuple[dict[int, np.ndarray], int]:
    """Occurrences of the block's grams over all documents, as many rows as it has grams at most, and the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sums = {k: np.zeros(len(g), np.int64) for k, g in items.grams.items()} | {0: np.zeros(1, np.int64)}
        for batch in batches:
            sums[0] += batch.num_rows
            for text in batch.column(0).to_pylist():
                ids = items.doc_ids(text)
                for k in items.lengths:
                    np.add.at(sums[k], items.hits(ids, k)[1], 1)
        for k, s in sums.items():
            no = np.flatnonzero(s)
            if len(no):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(no), k, np.int32)), pa.array(no), pa.array(s[no])], ["k", "no", "c"])

    rows = map_stream(docs.select(F.col(text_col).cast("string")), run, "k int, no long, c long").groupBy("k", "no").agg(F.sum("c").alias("c")).toPandas()
    out = {k: np.zeros(len(g), np.int64) for k, g in items.grams.items()}
    for k in items.lengths:
        own = rows[rows.k == k]
        out[k][own.no.to_numpy()] = own.c.to_numpy()
    return out, int(rows[rows.k == 0].c.sum())


def _add_block(docs: DataFrame, items: Items, text_col: str, hits_col: str, threshold: float) -> DataFrame:
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(items)  # a block is of bounded size

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = sent.value
        jobs, spans = [], []
        for r, text in enumerate(batch.column(at).to_pylist()):
            ids = own.doc_ids(text)
            for i, a, b in own.passages(ids, threshold):
                jobs.append((r, i, ids[a:b]))
                spans.append(a)
        hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for (r, i, _), a, (score, s, e) in zip(jobs, spans, _align_all(own, jobs), strict=True):
            share = score / (MATCH * len(own.tokens[i]))
            if share >= threshold and (share, -a - s) > (best[r, i][0], -best[r, i][1]) if (r, i) in best else share >= threshold:
                best[r, i] = (share, a + s, a + e)
        for (r, i), (share, s, e) in sorted(best.items()):
            hits[r].append({"item_id": own.ids[i], "score": share, "first_word": s, "end_word": e})
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, kind)], [*batch.schema.names, hits_col])

    schema = StructType([*docs.schema.fields, StructField(hits_col, ArrayType(HIT))])
    return map_batches(docs, run, schema)


def add_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", hits_col: str = "hits", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with an array of the test items that each whole text holds copies of.

    An element has the item's id, its best alignment score as a share of the
    perfect one, and the first word and end word (exclusive) of the passage.
    Items that differ only in id give an element each. Items of fewer than ``N``
    words are sought as one gram; null texts and texts without words match
    nothing. All columns and rows of ``docs`` stay, repeated ones too; an empty
    benchmark gives empty arrays. ``hits_col`` must be a new name.
    """
    if hits_col in docs.columns:
        raise ValueError(f"{hits_col} is a column already")
    items = benchmark.select(F.col(item_id_col).cast("long").alias("i"), F.col(item_text_col).cast("string").alias("t")).where("t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    parts = []
    out = docs
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        block = Items.build([(r.i, r.t) for r in rows])
        if not block.tokens:
            continue
        block.choose_seeds(*_count_grams(docs, block, text_col))
        name = free_name(out, f"{hits_col}__{b}")
        out = _add_block(out, block, text_col, name, threshold)
        parts.append(name)
    none = F.array().cast(ArrayType(HIT))
    return out.withColumn(hits_col, F.concat(*parts) if parts else none).drop(*parts)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, score, first_word, end_word)``: one row for each document and item it holds a copy of."""
    found = add_hits(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark, threshold=threshold)
    return found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
