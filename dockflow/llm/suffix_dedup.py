"""Exact repeated-passage removal over a distributed sparse suffix array.

A byte goes if a string of ``MATCH`` bytes that covers it also starts in a
document of smaller id. Not every suffix is sorted. In each window of ``MATCH``
bytes the 20-byte string of least hash is its anchor, which depends on nothing
but the window, so equal windows have equal anchors at equal places; about every
sixteenth byte is one. Windows that follow each other and share their anchor are
one record: the bytes they cover, and where the anchor is.

1. Anchors are compared by hash over all documents; only windows whose anchor is
   in two documents or more go on.
2. Their records are range-partitioned by 12 leading bytes of the suffix at the
   anchor, and by the anchor's hash where many begin alike; splitters are quantiles of
   a sample of all anchors.
3. A bucket sorts the windows of its records by multikey quicksort, eight bytes
   a symbol: groups that are equal so far are split by their next symbol, and
   groups of one leave. Windows equal in all symbols get their least id. Equal
   windows have equal leading bytes at the anchor and hence share a bucket. Anchors
   in so many documents that they would fill a bucket are dealt by the window's
   digest instead, each window once per chunk: the same comparison across what
   would be bucket boundaries.
4. Each chunk of documents gets the answers to its own records and cuts its texts.

Documents travel once, compressed, into a table bucketed by chunk; the joins of
steps 2 and 4 read it where it lies. Digests have 64 bits (windows dealt by digest:
128), bucket by bucket, beside the comparison of bytes in step 3.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import grouped, id_text, map_batches, map_stream, settle
from dockflow.llm.chunks import LAST, batch_of, chunk_table, each_chunk, from_planes, ids_of, mix, pack, planes, spread, texts_of, unpack

MATCH = 50
GRAM = 20
SPAN = MATCH - GRAM + 1
#: Positions handled at once.
BLOCK_BITS = 20
PIECE = 1 << 19
#: Documents of an anchor from which its windows are dealt by digest.
HOT_DOCS = 1024
SAMPLES = 64


def _words(data: bytes) -> np.ndarray:
    """The 8 bytes that start at each byte, as little-endian integers; zeros follow the end."""
    padded = data + bytes(16)
    return np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))


@dataclass
class Records:
    """Runs of windows with one anchor, in one block of text."""

    words: np.ndarray
    doc: np.ndarray  # number of the document in its chunk
    at: np.ndarray  # first window, in the block
    count: np.ndarray  # windows
    anchor: np.ndarray  # place of the anchor, in the block
    gram: np.ndarray  # hash of the anchor
    shift: np.ndarray  # block place + shift = place in the document

    def pick(self, keep: np.ndarray) -> Records:
        return Records(self.words, *(x[keep] for x in (self.doc, self.at, self.count, self.anchor, self.gram, self.shift)))

    def digest(self) -> np.ndarray:
        """One hash for a record's bytes and its anchor's place; words from both ends cover all bytes."""
        end = self.at + self.count + MATCH - 1
        some = [self.words[self.at + k] for k in (0, 8, 16, 24, 32, 40, MATCH - 8)] + [self.words[end - k] for k in (8, 16, 24, 32)]
        return mix([*some, (self.count * 64 + self.anchor - self.at).astype(np.uint64)], 1)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Record number and place of each window."""
        of = np.repeat(np.arange(len(self.at)), self.count)
        return of, self.at[of] + np.arange(len(of)) - np.repeat(np.cumsum(self.count) - self.count, self.count)


def window_digests(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some = [words[at + k] for k in (0, 8, 16, 24, 32, 40, MATCH - 8)]
    return mix(some, 2), mix(some, 3)


def _least_owner(key: np.ndarray) -> np.ndarray:
    """Minimum over ``SPAN`` values from each place on."""
    out, width = key, 1
    while 2 * width <= SPAN:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[: len(out) - (SPAN - width)], out[SPAN - width:])


def records(texts: list[bytes]) -> Iterator[Records]:
    """The records of a chunk, block by block. Long texts come in pieces that overlap by a window."""
    pieces = [(d, s) for d, t in enumerate(texts) for s in range(0, max(len(t) - MATCH + 1, 0), PIECE - MATCH + 1)]
    held: list[tuple[int, int]] = []
    size = 0
    for p in [*pieces, None]:
        n = min(PIECE, len(texts[p[0]]) - p[1]) if p else 0
        if held and (p is None or size + n > 1 << BLOCK_BITS):
            yield _block(held, texts)
            held, size = [], 0
        if p:
            held.append(p)
            size += n


def _block(pieces: list[tuple[int, int]], texts: list[bytes]) -> Records:
    parts = [texts[d][s:s + PIECE] for d, s in pieces]
    sizes = np.array([len(x) for x in parts])
    starts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    words = _words(b"".join(parts))
    gram = mix([words[:n], words[8:n + 8], words[np.minimum(np.arange(GRAM - 8, n + GRAM - 8), n + 8)]])
    place = np.arange(n, dtype=np.uint64)
    low = np.uint64((1 << BLOCK_BITS) - 1)
    best = _least_owner((gram & ~low) | place)
    piece = np.repeat(np.arange(len(sizes)), sizes)[: len(best)]
    ok = np.flatnonzero(np.arange(len(best)) + MATCH <= (starts + sizes)[piece])
    owner, piece = (best[ok] & low).astype(np.int64), piece[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(ok)))
    gram = mix([gram], 2)  # least hashes are all small: mixed again, they spread evenly over ranges
    numbers = np.array([d for d, _ in pieces], np.int64)
    shift = np.array([s for _, s in pieces], np.int64) - starts
    own = piece[first]
    return Records(words, numbers[own], ok[first], count, owner[first], gram[owner[first]], shift[own])


def _lead(r: Records) -> tuple[np.ndarray, np.ndarray]:
    """The 12 leading bytes of the suffix at the anchor, then 32 bits of the anchor's hash, as two numbers in the order of bytes.

    The hash comes last so that splitters can part anchors that begin alike: equal
    windows have the same one.
    """
    low = np.uint64((1 << 32) - 1)
    return r.words[r.anchor].byteswap(), (r.words[r.anchor + 8].byteswap() & ~low) | (mix([r.gram], 3) >> np.uint64(32))


def _bucket_of(splitters: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The number of splitters (rows of two numbers, in order) at or below each pair."""
    first = splitters[:, 0]
    to = np.searchsorted(first, one, side="left")
    for value in np.unique(first):  # pairs that share a splitter's first number go by their second
        at = np.flatnonzero(one == value)
        a, b = np.searchsorted(first, value, side="left"), np.searchsorted(first, value, side="right")
        to[at] = a + np.searchsorted(splitters[a:b, 1], two[at], side="right")
    return to


def _anchor_rows(buckets: int):
    """Step 1, per chunk: anchors and the number of its documents that have them, by ranges of the hash."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for chunk, _, texts, _ in each_chunk(batch):
            grams, docs, leads = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty((2, 0), np.uint64)]
            for r in records(texts):
                grams.append(r.gram)
                docs.append(r.doc)
                leads.append(np.stack(_lead(r)))
            g, d, lead = np.concatenate(grams), np.concatenate(docs), np.concatenate(leads, axis=1)
            if not len(g):
                continue
            some = np.argsort(g)[:: max(1, len(g) // SAMPLES)]
            out.append((-1 - chunk % 64, chunk, pack(lead[0, some], lead[1, some])))
            order = np.lexsort((d, g))
            g, d = g[order], d[order]
            new = np.ones(len(g), bool)
            new[1:] = g[1:] != g[:-1]
            pair = new.copy()
            pair[1:] |= d[1:] != d[:-1]
            first = np.flatnonzero(new)
            count = np.minimum(np.add.reduceat(pair.astype(np.int64), first), 65535).astype("<u2")
            own = g[first]
            to = spread(own, buckets)
            cut = np.flatnonzero(np.diff(to, prepend=-1))
            for a, b in zip(cut, np.append(cut[1:], len(own)), strict=True):
                out.append((int(to[a]), chunk, pack(planes(own[a:b]), count[a:b])))
        return batch_of(["bucket", "chunk", "payload"], [pa.int64(), pa.int64(), pa.binary()], out)

    return run


def _shared_anchors(hot_docs: int):
    """Step 1, per range: which anchors are in two documents, and which in very many; told to their chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for (bucket,), t in grouped(batches, ["bucket"]):
            chunks, payloads = t.column("chunk").to_numpy(), t.column("payload").to_pylist()
            if bucket < 0:  # the sample of leading bytes
                yield batch_of(["bucket", "chunk", "payload"], [pa.int64(), pa.int64(), pa.binary()], [(bucket, c, p) for c, p in zip(chunks.tolist(), payloads, strict=True)])
                continue
            grams, counts = [], []
            for p in payloads:
                gaps, count = unpack(p, "u1", "<u2")
                grams.append(from_planes(gaps))
                counts.append(count)
            size = [len(g) for g in grams]
            g, n = np.concatenate(grams), np.concatenate(counts).astype(np.int64)
            order = np.argsort(g, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(g[order]) != 0))
            total = np.add.reduceat(n[order], first)
            docs = np.empty(len(g), np.int64)
            docs[order] = np.repeat(total, np.diff(np.append(first, len(g))))
            out, at = [], 0
            for c, own, k in zip(chunks.tolist(), grams, size, strict=True):
                many = docs[at:at + k]
                keep = many > 1
                if keep.any():
                    out.append((bucket, c, pack(planes(own[keep]), (many[keep] >= hot_docs).astype(np.uint8))))
                at += k
            if out:
                yield batch_of(["bucket", "chunk", "payload"], [pa.int64(), pa.int64(), pa.binary()], out)

    return run


def _record_rows(splitters: np.ndarray, buckets: int):
    """Step 2, per chunk: distinct records by leading bytes, and windows of hot anchors by digest."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for chunk, ids, texts, (told,) in each_chunk(batch):
            known = [unpack(p, "u1", "u1") for p in told]
            shared = np.concatenate([from_planes(p) for p, _ in known])
            hot = np.concatenate([h for _, h in known])
            order = np.argsort(shared)
            shared, hot = shared[order], hot[order]
            parts, wins = [], []
            for r in records(texts):
                no = np.minimum(np.searchsorted(shared, r.gram), len(shared) - 1)
                ok = shared[no] == r.gram
                warm = ok & (hot[no] == 0)
                if warm.any():
                    w = r.pick(warm)
                    parts.append((w, w.digest(), ids[w.doc], *_lead(w)))
                if (ok & ~warm).any():
                    w = r.pick(ok & ~warm)
                    of, at = w.windows()
                    one, two = window_digests(w.words, at)
                    wins.append((one, two, ids[w.doc][of], w.gram[of]))
            if parts:
                digest, doc, lead, more = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3, 4))
                to = _bucket_of(splitters, lead, more)
                block = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
                inner = np.concatenate([np.arange(len(p[1])) for p in parts])
                order = np.lexsort((doc, digest, more, lead, to))
                new = np.ones(len(order), bool)
                new[1:] = (digest[order][1:] != digest[order][:-1]) | (lead[order][1:] != lead[order][:-1])
                first = np.flatnonzero(new)
                low, high = doc[order][first], doc[order][np.append(first[1:], len(order)) - 1]
                at = order[first]
                to_first = to[at]
                cut = np.flatnonzero(np.diff(to_first, prepend=-1))
                buffers = [p[0].words.base for p in parts]
                for a, b in zip(cut.tolist(), np.append(cut[1:], len(first)).tolist(), strict=True):
                    length, off, text = [], [], []
                    for k in at[a:b].tolist():
                        r, i = parts[block[k]][0], inner[k]
                        s, n = int(r.at[i]), int(r.count[i])
                        length.append(n)
                        off.append(int(r.anchor[i]) - s)
                        text.append(buffers[block[k]][s:s + n + MATCH - 1])
                    out.append((int(to_first[a]), chunk, pack(np.array(length, np.uint8), np.array(off, np.uint8), low[a:b], high[a:b], b"".join(text))))
            if wins:
                one, two, doc, gram = (np.concatenate([w[k] for w in wins]) for k in range(4))
                order = np.lexsort((doc, two, one))
                one, two, doc, gram = one[order], two[order], doc[order], gram[order]
                new = np.ones(len(one), bool)
                new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                first = np.flatnonzero(new)
                low, high = doc[first], doc[np.append(first[1:], len(one)) - 1]
                one, two, gram = one[first], two[first], gram[first]
                to = spread(one, buckets)
                cut = np.flatnonzero(np.diff(to, prepend=-1))
                for a, b in zip(cut, np.append(cut[1:], len(one)), strict=True):
                    s = slice(a, b)
                    out.append((buckets + int(to[a]), chunk, pack(planes(one[s]), two[s], low[s], high[s], gram[s])))
        return batch_of(["bucket", "chunk", "payload"], [pa.int64(), pa.int64(), pa.binary()], out)

    return run


def multikey_groups(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Group numbers of the ``MATCH``-byte windows at ``at``: equal for equal windows, -1 for those without an equal.

    Multikey quicksort on eight-byte symbols: all groups that are equal so far
    are sorted by their next symbol at once, and go on where it is equal too.
    """
    group = np.full(len(at), -1, np.int64)
    active, label = np.arange(len(at)), np.zeros(len(at), np.int64)
    for depth in (0, 8, 16, 24, 32, 40, MATCH - 8):
        if not len(active):
            break
        symbol = words[at[active] + depth].byteswap()
        order = np.lexsort((symbol, label))
        active, label, symbol = active[order], label[order], symbol[order]
        new = np.ones(len(active), bool)
        new[1:] = (label[1:] != label[:-1]) | (symbol[1:] != symbol[:-1])
        label = np.cumsum(new) - 1
        keep = np.bincount(label)[label] > 1
        active, label = active[keep], label[keep]
    group[active] = label
    return group


def _bucket_answers(buckets: int):
    """Step 3: the least id of each window, told to the chunks that have it under a larger one."""

    def by_bytes(t: pa.Table) -> list[tuple]:
        chunks = t.column("chunk").to_pylist()
        count, off, low, high, texts = [], [], [], [], []
        for p in t.column("payload").to_pylist():
            a, b, c, d, e = unpack(p, "u1", "u1", "<i8", "<i8", "u1")
            count.append(a)
            off.append(b)
            low.append(c)
            high.append(d)
            texts.append(e.tobytes())
        source = np.repeat(np.arange(len(chunks)), [len(c) for c in count])
        n, place, first, last = (np.concatenate(x) for x in (count, off, low, high))
        n = n.astype(np.int64)
        at = np.cumsum(n + MATCH - 1) - (n + MATCH - 1)
        words = _words(b"".join(texts))
        r = Records(words, source, at, n, at + place, np.zeros(len(n), np.uint64), at)
        digest = r.digest()
        _, one, same = np.unique(digest, return_index=True, return_inverse=True)
        least = np.full(len(one), LAST)
        np.minimum.at(least, same, first)
        distinct = r.pick(one)
        of, window = distinct.windows()
        group = multikey_groups(words, window)
        best = least[of].copy()
        many = group >= 0
        if many.any():
            small = np.full(int(group.max()) + 1, LAST)
            np.minimum.at(small, group[many], best[many])
            best[many] = small[group[many]]
        begin = np.cumsum(distinct.count) - distinct.count
        of, _ = r.windows()
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        value = best[begin[same[of]] + k]
        told = np.flatnonzero(value < last[of])
        if not len(told):
            return []
        of, k, value = of[told], k[told], value[told]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (k[1:] != k[:-1] + 1) | (value[1:] != value[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(of)) - 1
        out = []
        src = source[of[head]]
        cut = np.flatnonzero(np.diff(src, prepend=-1))
        for a, b in zip(cut, np.append(cut[1:], len(head)), strict=True):
            h, e = head[a:b], tail[a:b]
            out.append((chunks[src[a]], 0, pack(digest[of[h]], k[h].astype(np.uint8), k[e].astype(np.uint8), value[h])))
        return out

    def by_digest(t: pa.Table) -> list[tuple]:
        chunks, cells = t.column("chunk").to_pylist(), [unpack(p, "u1", "<u8", "<i8", "<i8", "<u8") for p in t.column("payload").to_pylist()]
        one = np.concatenate([from_planes(c[0]) for c in cells])
        two, low, high, gram = (np.concatenate([c[k] for c in cells]) for k in (1, 2, 3, 4))
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        small = np.minimum.reduceat(low[order], first)
        best = np.empty(len(a), np.int64)
        best[order] = np.repeat(small, np.diff(np.append(first, len(a))))
        out, at = [], 0
        for chunk, c in zip(chunks, cells, strict=True):
            s = slice(at, at + len(c[1]))
            keep = best[s] < high[s]
            if keep.any():
                out.append((chunk, 1, pack(one[s][keep], two[s][keep], best[s][keep], np.unique(gram[s][keep]))))
            at += len(c[1])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for (bucket,), t in grouped(batches, ["bucket"]):
            rows = by_bytes(t) if bucket < buckets else by_digest(t)
            if rows:
                yield batch_of(["chunk", "kind", "payload"], [pa.int64(), pa.int32(), pa.binary()], rows)

    return run


def _intervals(ids: np.ndarray, texts: list[bytes], told: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, start and end of each run of windows that starts in a smaller id too."""
    cells = [unpack(x["payload"], "<u8", "u1", "u1", "<i8") for x in told if x["kind"] == 0]
    wins = [unpack(x["payload"], "<u8", "<u8", "<i8", "<u8") for x in told if x["kind"] == 1]
    digest, since, until, least = (np.concatenate([c[k] for c in cells]) if cells else np.empty(0, np.uint64 if not k else np.int64) for k in range(4))
    order = np.argsort(digest, kind="stable")
    digest, since, until, least = digest[order], since[order].astype(np.int64), until[order].astype(np.int64), least[order]
    if wins:
        one, two, best = (np.concatenate([w[k] for w in wins]) for k in range(3))
        hot = np.unique(np.concatenate([w[3] for w in wins]))
        order = np.lexsort((two, one))
        one, two, best = one[order], two[order], best[order]
    doc, start, end = [], [], []
    for r in records(texts):
        if len(digest):
            d = r.digest()
            a, b = np.searchsorted(digest, d, side="left"), np.searchsorted(digest, d, side="right")
            many = b - a
            rec = np.repeat(np.arange(len(d)), many)
            row = np.repeat(a, many) + np.arange(len(rec)) - np.repeat(np.cumsum(many) - many, many)
            ok = least[row] < ids[r.doc[rec]]
            rec, row = rec[ok], row[ok]
            place = r.at[rec] + r.shift[rec]
            doc.append(r.doc[rec])
            start.append(place + since[row])
            end.append(place + until[row] + MATCH)
        if wins:
            w = r.pick(np.isin(r.gram, hot))
            of, at = w.windows()
            x, y = window_digests(w.words, at)
            no = np.minimum(np.searchsorted(one, x), len(one) - 1)
            while True:  # equal first halves stand side by side
                step = (one[no] == x) & (two[no] < y) & (no + 1 < len(one))
                step[step] &= one[no[step] + 1] == x[step]
                if not step.any():
                    break
                no[step] += 1
            ok = (one[no] == x) & (two[no] == y) & (best[no] < ids[w.doc[of]])
            of, place = of[ok], at[ok] + w.shift[of[ok]]
            doc.append(w.doc[of])
            start.append(place)
            end.append(place + MATCH)
    if not doc:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(doc), np.concatenate(start), np.concatenate(end)


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Step 4: merged spans and what is left of each text."""
    ids, spans, kept, sizes = [], [], [], []
    for i in range(batch.num_rows):
        _, own, lengths, data, told = (batch.column(c)[i].as_py() for c in range(5))
        texts = texts_of(lengths, data)
        doc, start, end = _intervals(ids_of(own), texts, told or [])
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
        at = np.searchsorted(doc, np.arange(len(texts) + 1))
        for k, text in enumerate(texts):
            merged: list[list[int]] = []
            for s, e in zip(start[at[k]:at[k + 1]].tolist(), end[at[k]:at[k + 1]].tolist(), strict=True):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            edges = [0, *(x for m in merged for x in m), len(text)]
            ids.append(own[k])
            sizes.append(len(text))
            spans.append([{"start": s, "end": e} for s, e in merged])
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def _splitters(sample: DataFrame, buckets: int) -> np.ndarray:
    """Quantiles of the leading bytes of sampled anchors, from at most ``SAMPLES`` for each bucket."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = [unpack(p, "<u8", "<u8") for p in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([c[k] for c in cells]).view(np.int64)) for k in (0, 1)], ["one", "two"])

    some = map_batches(sample.select("payload"), run, "one long, two long").orderBy(F.xxhash64("one", "two"), "one", "two").limit(SAMPLES * buckets).toPandas()
    pairs = some.to_numpy(np.int64).view(np.uint64).reshape(-1, 2)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return np.unique(pairs[len(pairs) * np.arange(1, buckets) // buckets], axis=0) if len(pairs) else pairs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_docs: int = HOT_DOCS) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``, a row for each row of ``docs``.

    ``spans``: the maximal removed runs of the UTF-8 bytes as (start, end), end
    exclusive; ``kept``: the other bytes joined. Null and empty texts keep
    nothing and lose nothing, texts under ``MATCH`` bytes stay whole. A null id
    counts as larger than any other; rows of one id don't remove each other's
    bytes. Repeated rows and ties give each row its own result; extra columns
    are not read, an empty table gives an empty one.
    """
    spark = docs.sparkSession
    buckets = max(2, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = "bucket long, chunk long, payload binary"
    chunks = chunk_table(id_text(docs, id_col, text_col), buckets // 2)
    anchors = map_batches(chunks, _anchor_rows(buckets), parts)
    dealt = anchors.repartition(buckets // 2, "bucket").sortWithinPartitions("bucket")
    told = settle(map_stream(dealt, _shared_anchors(hot_docs), parts), "shared-anchors")
    splitters = _splitters(told.where("bucket < 0"), buckets)
    own = told.where("bucket >= 0").groupBy("chunk").agg(F.collect_list("payload").alias("told"))  # a chunk's own anchors
    rows = map_batches(chunks.join(own, "chunk").select("chunk", "ids", "sizes", "data", "told"), _record_rows(splitters, buckets), parts)
    sorted_rows = rows.repartition(buckets // 2, "bucket").sortWithinPartitions("bucket")
    answers = settle(map_stream(sorted_rows, _bucket_answers(buckets), "chunk long, kind int, payload binary"), "window-answers")
    mine = answers.groupBy("chunk").agg(F.collect_list(F.struct("kind", "payload")).alias("told"))
    whole = chunks.join(mine, "chunk", "left").select("chunk", "ids", "sizes", "data", "told")
    return map_batches(whole, _cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
