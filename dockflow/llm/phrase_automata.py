"""Removal of repeated passages by Aho-Corasick automata over words.

A window is ``WINDOW`` consecutive words of a document. A word goes if a window
that covers it, word for word, also starts in a document of smaller id.

1. In each window the run of ``PHRASE`` words of least hash is its anchor. It
   depends on nothing but the window, so equal windows have equal anchors. Anchors
   are counted over all documents; a window whose anchor is in one document only
   recurs nowhere.
2. Windows that follow each other and share their anchor are an entry. Equal
   entries of a chunk of documents are merged (by their words, not by a hash), and
   go to the shard of their anchor. Anchors with very many different entries would
   fill a shard: their windows are entries of their own and go by the window's
   hash.
3. A shard confirms recurring passages: windows of equal hash that stand in two
   documents, joined to longer passages where they always stand together. It
   compiles the passages into automata of bounded size and streams its entries
   through them: every occurrence is located word by word. A window that no match
   covers is compiled by itself and sought again, so neither a hash collision nor a
   wrong guess about what stands together can lose or invent one.
4. Each chunk gets the least ids of its own entries and cuts its texts.

All documents pass the automata, but a part of a document only those of the shard
its anchor belongs to: no other shard can hold a passage that covers it. So the
work grows with the text, not with shards times text. In automata a word is one
symbol, the number of the word in its shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import grouped, id_text, map_batches, map_stream, settle
from dockflow.llm.chunks import LAST, batch_of, chunk_table, each_chunk, from_planes, mix, pack, planes, spread, unpack

WINDOW, PHRASE = 50, 16
SPAN = WINDOW - PHRASE + 1
#: Words of a document handled at once, and of a block of documents.
PIECE, BLOCK_BITS = 1 << 16, 17
#: Words longer than this stand in entries as a digest, so that an entry's size is bounded.
LONG_WORD = 64
#: Words of the entries that one automaton is compiled from (more if one anchor has more).
SHARD_WORDS = 1 << 17
#: An anchor's windows go by themselves if its entries are more than so many, or than a quarter of a shard's even share.
MOST_ENTRIES, LEAST_ENTRIES = 1024, 64
PARTS = "bucket long, chunk long, payload binary"
PART_KINDS = [pa.int64(), pa.int64(), pa.binary()]
PART_NAMES = ["bucket", "chunk", "payload"]


class WordHashes(dict):
    """Hash of each word met so far."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def least_place(key: np.ndarray, span: int) -> np.ndarray:
    """Minimum over ``span`` values from each place on."""
    out, width = key, 1
    while 2 * width <= span:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[: len(out) - (span - width)], out[span - width:])


def runs_hash(h: np.ndarray, *widths: int) -> list[np.ndarray]:
    """For each width (a power of two, ascending) the hashes of as many values in a row."""
    out, width = [], 1
    while True:
        if width in widths:
            out.append(h)
        if width == widths[-1]:
            return out
        h = mix([h[:-width], h[width:]], 1) if len(h) > width else np.empty(0, np.uint64)
        width *= 2


def windows_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the phrases and of the windows that start at each word."""
    two, phrase, half = runs_hash(h, 2, PHRASE, 32)
    n = max(0, len(h) - WINDOW + 1)
    return phrase, mix([half[:n], phrase[32:32 + n], two[48:48 + n]], 2) if n else np.empty(0, np.uint64)


@dataclass
class Entries:
    """Runs of windows with one anchor, of one block."""

    words: list[bytes]
    doc: np.ndarray  # number of the document in its chunk
    at: np.ndarray  # first window, in the block
    count: np.ndarray  # windows
    gram: np.ndarray  # number of the anchor, from its hash
    digest: np.ndarray  # hash of the entry's words
    place: np.ndarray  # first word, in the document


def entries_of(texts: list[bytes]) -> Iterator[Entries]:
    """The entries of a chunk, block by block; long texts come in pieces that overlap by a window less a word."""
    words: list[bytes] = []
    parts: list[tuple[int, int, int]] = []
    hashes = WordHashes()
    for d, text in enumerate(texts):
        own = text.split()
        for s in range(0, max(len(own) - WINDOW + 1, 0), PIECE - WINDOW + 1):
            piece = own[s:s + PIECE]
            if words and len(words) + len(piece) > 1 << BLOCK_BITS:
                yield _block(words, parts, hashes)
                words, parts = [], []
            parts.append((d, s, len(piece)))
            words.extend(piece)
    if words:
        yield _block(words, parts, hashes)


def _block(words: list[bytes], parts: list[tuple[int, int, int]], hashes: WordHashes) -> Entries:
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    phrase, window = windows_hash(h)
    low = np.uint64((1 << BLOCK_BITS) - 1)
    best = least_place((phrase & ~low) | np.arange(len(phrase), dtype=np.uint64), SPAN)
    docs, since, sizes = (np.array(x, np.int64) for x in zip(*parts))
    starts = np.cumsum(sizes) - sizes
    piece = np.repeat(np.arange(len(sizes)), sizes)[: len(best)]
    ok = np.flatnonzero(np.arange(len(best)) + WINDOW <= (starts + sizes)[piece])
    owner, piece = (best[ok] & low).astype(np.int64), piece[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(ok)))
    at, own = ok[first], piece[first]
    digest = mix([window[at], window[at + count - 1], count.astype(np.uint64)], 3)
    # Least hashes are all small: mixed again, they spread evenly over shards.
    return Entries(words, docs[own], at, count, mix([phrase[owner[first]]], 0), digest, at - starts[own] + since[own])


def entry_text(words: list[bytes]) -> bytes:
    """The words between spaces; a long one as its digest behind a byte that UTF-8 doesn't have."""
    if max(map(len, words)) > LONG_WORD:
        words = [b"\xff" + hashlib.sha256(w).hexdigest().encode() if len(w) > LONG_WORD else w for w in words]
    return b" ".join(words)


def _anchor_rows(buckets: int):
    """Step 1, per chunk: its anchors, in how many documents and with how many different entries."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for chunk, _, texts, _ in each_chunk(batch):
            some = [(e.gram, e.digest, e.doc) for e in entries_of(texts)]
            if not some:
                continue
            gram, digest, doc = (np.concatenate(x) for x in zip(*some))

            def different(other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                order = np.lexsort((other, gram))
                g, o = gram[order], other[order]
                new = np.append(True, g[1:] != g[:-1])
                first = np.flatnonzero(new)
                pair = new.copy()
                pair[1:] |= o[1:] != o[:-1]
                return g[first], np.add.reduceat(pair.astype(np.int64), first)

            own, docs = different(doc)
            entries = different(digest)[1]
            counts = [np.minimum(c, 65535).astype("<u2") for c in (docs, entries)]
            to = spread(own, buckets)
            cut = np.flatnonzero(np.diff(to, prepend=-1))
            for a, b in zip(cut, np.append(cut[1:], len(own)), strict=True):
                out.append((int(to[a]), chunk, pack(planes(own[a:b]), counts[0][a:b], counts[1][a:b])))
        return batch_of(PART_NAMES, PART_KINDS, out)

    return run


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Step 1, per range of hashes: the anchors of two documents and more, told to their chunks with the number of their entries."""
    for (bucket,), t in grouped(batches, ["bucket"]):
        chunks = t.column("chunk").to_pylist()
        grams, docs, entries = [], [], []
        for p in t.column("payload").to_pylist():
            own, d, e = unpack(p, "u1", "<u2", "<u2")
            grams.append(from_planes(own))
            docs.append(d)
            entries.append(e)
        size = [len(g) for g in grams]
        g, d, e = np.concatenate(grams), np.concatenate(docs).astype(np.int64), np.concatenate(entries).astype(np.int64)
        order = np.argsort(g, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(g[order]) != 0))
        repeat = np.diff(np.append(first, len(g)))
        total, many = np.empty(len(g), np.int64), np.empty(len(g), np.int64)
        total[order] = np.repeat(np.add.reduceat(d[order], first), repeat)
        many[order] = np.repeat(np.add.reduceat(e[order], first), repeat)
        out, at = [], 0
        for c, own, k in zip(chunks, grams, size, strict=True):
            keep = total[at:at + k] > 1
            if keep.any():
                told = np.minimum(many[at:at + k][keep], (1 << 32) - 1).astype("<u4")
                out.append((c, int(e[at:at + k][keep].sum()), pack(planes(own[keep]), told)))
            at += k
        if out:
            yield batch_of(["chunk", "n", "payload"], [pa.int64(), pa.int64(), pa.binary()], out)


def _entry_rows(buckets: int, most: int):
    """Step 2, per chunk: different entries by shard, and where in the chunk they stand."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for chunk, ids, texts, (told,) in each_chunk(batch):
            known = [unpack(p, "u1", "<u4") for p in told]
            shared, many = np.concatenate([from_planes(p) for p, _ in known]), np.concatenate([m for _, m in known])
            order = np.argsort(shared)
            shared, many = shared[order], many[order]
            number: dict[bytes, int] = {}
            gram, hot = [], []
            who, doc, place = [], [], []
            for e in entries_of(texts):
                no = np.minimum(np.searchsorted(shared, e.gram), len(shared) - 1)
                ok = np.flatnonzero(shared[no] == e.gram)
                for a, n, g, h in zip(e.at[ok].tolist(), e.count[ok].tolist(), e.gram[ok].tolist(), (many[no[ok]] > most).tolist(), strict=True):
                    text = entry_text(e.words[a:a + n + WINDOW - 1])
                    k = number.setdefault(text, len(number))
                    if k == len(gram):
                        gram.append(g)
                        hot.append(h)
                    who.append(k)
                doc.append(e.doc[ok])
                place.append(e.place[ok])
            if not who:
                continue
            who, doc, place = np.array(who, np.int64), np.concatenate(doc), np.concatenate(place)
            low, high = np.full(len(gram), LAST), np.full(len(gram), np.iinfo(np.int64).min)
            np.minimum.at(low, who, ids[doc])
            np.maximum.at(high, who, ids[doc])
            items = [(t, g, k) for (t, k), g, h in zip(number.items(), gram, hot, strict=True) if not h]
            at_text: dict[bytes, int] = {}
            pairs: list[tuple[int, int, int]] = []  # entry of a window, entry it is in, place there
            for (text, k), h in zip(number.items(), hot, strict=True):
                if h:
                    words = text.split(b" ")
                    for s in range(len(words) - WINDOW + 1):
                        pairs.append((at_text.setdefault(b" ".join(words[s:s + WINDOW]), len(gram) + len(at_text)), k, s))
            single = np.array(pairs, np.int64).reshape(-1, 3)
            if len(single):
                more = [np.full(len(at_text), LAST), np.full(len(at_text), np.iinfo(np.int64).min)]
                np.minimum.at(more[0], single[:, 0] - len(gram), low[single[:, 1]])
                np.maximum.at(more[1], single[:, 0] - len(gram), high[single[:, 1]])
                low, high = np.append(low, more[0]), np.append(high, more[1])
                items += [(t, xxhash.xxh64_intdigest(t), k) for t, k in at_text.items()]
            to = spread(np.array([g for _, g, _ in items], np.uint64), buckets)
            order = np.argsort(to, kind="stable")
            cut = np.flatnonzero(np.diff(to[order], prepend=-1))
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(order)).tolist(), strict=True):
                own = [items[i] for i in order[a:b].tolist()]
                no = np.array([k for _, _, k in own], np.int64)
                out.append((int(to[order[a]]), chunk, pack(
                    no.astype("<u4"), low[no], high[no], np.array([g for _, g, _ in own], "<u8"), np.array([len(t) for t, _, _ in own], "<u4"), b"".join(t for t, _, _ in own))))
            out.append((-1 - chunk, chunk, pack(who.astype("<u4"), doc.astype("<u4"), place, single.astype("<u4").ravel())))
        return batch_of(PART_NAMES, PART_KINDS, out)

    return run


class Shard:
    """Entries (different texts of one or more anchors) and the least id of each of their windows."""

    def __init__(self, texts: list[bytes], low: np.ndarray, high: np.ndarray):
        number: dict[bytes, int] = {}
        rows = [[number.setdefault(w, len(number)) for w in t.split(b" ")] for t in texts]
        size = np.array([len(r) for r in rows])
        # One symbol for a word, one (0) behind each entry.
        self.symbols = np.concatenate([np.array([*r, -1], np.int64) + 1 for r in rows])
        self.symbols[self.symbols >= 0xD800] += 0x800  # no surrogates
        self.text = self.symbols.astype("<u4").tobytes().decode("utf-32-le")
        self.start = np.cumsum(size + 1) - (size + 1)
        self.count = size - WINDOW + 1
        self.entry = np.repeat(np.arange(len(texts)), self.count)  # of each window
        self.at = self.start[self.entry] + np.arange(len(self.entry)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        self.low, self.high = low, high

    def confirmed(self) -> np.ndarray:
        """Least id of each window's words over all entries; of windows in one document its own."""
        window = windows_hash(mix([self.symbols.astype(np.uint64)], 0))[1][self.at]
        _, first, same = np.unique(window, return_index=True, return_inverse=True)
        order = np.argsort(same, kind="stable")
        cut = np.searchsorted(same[order], np.arange(len(first)))
        least = np.minimum.reduceat(self.low[self.entry][order], cut)
        most = np.maximum.reduceat(self.high[self.entry][order], cut)
        together = np.add.reduceat(mix([self.entry.astype(np.uint64)], 2)[order], cut)  # which entries have it
        value = self.low[self.entry].copy()
        sought = (least < most)[same]
        if not sought.any():
            return value
        # Windows that stand for their class, joined where neighbours are in the same entries.
        leads = np.sort(first[(least < most)])
        joined = np.append(False, (np.diff(leads) == 1) & (self.entry[leads][1:] == self.entry[leads][:-1]) & (together[same[leads]][1:] == together[same[leads]][:-1]))
        begin = np.flatnonzero(~joined)
        passages = [(leads[a], b - a) for a, b in zip(begin, np.append(begin[1:], len(leads)), strict=True)]
        found = np.full(len(self.at), -1)  # the window that each one equals, word by word
        self._locate(passages, found)
        open_ = sought & (found < 0)
        if open_.any():  # a passage doesn't stand there as a whole: its windows one by one
            classes = np.unique(same[open_])
            found[np.isin(same, classes)] = -1
            self._locate([(w, 1) for w in first[classes]], found)
            open_ = sought & (found < 0)
        while open_.any():  # equal hash, other words
            classes, some = np.unique(same[open_], return_index=True)
            self._locate([(w, 1) for w in np.flatnonzero(open_)[some]], found)
            open_ = sought & (found < 0)
        own = np.flatnonzero(found >= 0)
        best = np.full(len(self.at), LAST)
        np.minimum.at(best, found[own], self.low[self.entry[own]])
        value[own] = best[found[own]]
        return value

    def _locate(self, passages: list[tuple[int, int]], found: np.ndarray) -> None:
        """Compile passages (first window, windows) and note for each window not yet found which one of theirs it equals."""
        automaton = ahocorasick.Automaton()
        for k, (w, n) in enumerate(passages):
            a = self.at[w]
            automaton.add_word(self.text[a:a + n + WINDOW - 1], k)
        automaton.make_automaton()
        hits = np.array(list(automaton.iter(self.text)), np.int64).reshape(-1, 2)
        first, size = (np.array(x, np.int64) for x in zip(*passages))
        n = size[hits[:, 1]]
        begin = hits[:, 0] - n - WINDOW + 2
        entry = np.searchsorted(self.start, begin, side="right") - 1
        window = (np.cumsum(self.count) - self.count)[entry] + begin - self.start[entry]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        to, lead = np.repeat(window, n) + step, np.repeat(first[hits[:, 1]], n) + step
        new = found[to] < 0
        found[to[new]] = lead[new]


def _shard_answers(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Step 3: the runs of windows that start in a smaller id too, told to the chunks that have them."""
    for (bucket,), t in grouped(batches, ["bucket"]):
        chunks, payloads = t.column("chunk").to_pylist(), t.column("payload").to_pylist()
        if bucket < 0:  # where entries stand: goes on to the chunk
            yield batch_of(["chunk", "kind", "payload"], [pa.int64(), pa.int32(), pa.binary()], [(c, 0, p) for c, p in zip(chunks, payloads, strict=True)])
            continue
        number: dict[bytes, int] = {}
        gram: list[int] = []
        source, who, no, low, high = [], [], [], [], []
        for s, p in enumerate(payloads):
            k, a, b, g, sizes, text = unpack(p, "<u4", "<i8", "<i8", "<u8", "<u4", "u1")
            raw, at = text.tobytes(), 0
            for size, hashed in zip(sizes.tolist(), g.tolist(), strict=True):
                n = number.setdefault(raw[at:at + size], len(number))
                if n == len(gram):
                    gram.append(hashed)
                who.append(n)
                at += size
            source.append(np.full(len(k), s))
            no.append(k)
            low.append(a)
            high.append(b)
        who, source, no, low, high = np.array(who), np.concatenate(source), np.concatenate(no), np.concatenate(low), np.concatenate(high)
        least, most = np.full(len(gram), LAST), np.full(len(gram), np.iinfo(np.int64).min)
        np.minimum.at(least, who, low)
        np.maximum.at(most, who, high)
        texts = list(number)
        order = np.argsort(np.array(gram, np.uint64), kind="stable")
        values: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
        some: list[int] = []
        words, last = 0, None

        def work() -> None:
            shard = Shard([texts[i] for i in some], least[some], most[some])
            for i, v in zip(some, np.split(shard.confirmed(), np.cumsum(shard.count)[:-1]), strict=True):
                values[i] = v

        for i in order.tolist():
            if some and words > SHARD_WORDS and gram[i] != last:
                work()
                some, words = [], 0
            some.append(i)
            words += texts[i].count(b" ") + 1
            last = gram[i]
        work()
        size = np.array([len(v) for v in values])
        begin = np.cumsum(size) - size
        flat = np.concatenate(values)
        n = size[who]
        of = np.repeat(np.arange(len(who)), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        value = flat[begin[who[of]] + k]
        told = np.flatnonzero(value < high[of])
        if not len(told):
            continue
        of, k, value = of[told], k[told], value[told]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (k[1:] != k[:-1] + 1) | (value[1:] != value[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(of)) - 1
        src = source[of[head]]
        cut = np.flatnonzero(np.diff(src, prepend=-1))
        out = []
        for a, b in zip(cut, np.append(cut[1:], len(head)), strict=True):
            h, e = head[a:b], tail[a:b]
            out.append((chunks[src[a]], 1, pack(no[of[h]].astype("<u4"), k[h].astype("<u1"), k[e].astype("<u1"), value[h])))
        yield batch_of(["chunk", "kind", "payload"], [pa.int64(), pa.int32(), pa.binary()], out)


def _intervals(ids: np.ndarray, told: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, first and end word of each run of windows that goes."""
    none = np.empty(0, np.int64)
    stands = [x["payload"] for x in told if x["kind"] == 0]
    answers = [unpack(x["payload"], "<u4", "<u1", "<u1", "<i8") for x in told if x["kind"] == 1]
    if not stands or not answers:
        return none, none, none
    who, doc, place, single = (x.astype(np.int64) for x in unpack(stands[0], "<u4", "<u4", "<i8", "<u4"))
    no, since, until, least = (np.concatenate([a[k] for a in answers]).astype(np.int64) for k in range(4))
    single = single.reshape(-1, 3)
    if len(single):  # windows by themselves: to the entries they are in
        order = np.argsort(single[:, 0], kind="stable")
        single = single[order]
        own = np.flatnonzero(no >= single[0, 0])
        a, b = np.searchsorted(single[:, 0], no[own], side="left"), np.searchsorted(single[:, 0], no[own], side="right")
        row = np.repeat(a, b - a) + np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
        value = np.repeat(least[own], b - a)
        rest = np.flatnonzero(no < single[0, 0])
        no, since, until, least = (np.append(x[rest], y) for x, y in ((no, single[row, 1]), (since, single[row, 2]), (until, single[row, 2]), (least, value)))
    order = np.argsort(who, kind="stable")
    who, doc, place = who[order], doc[order], place[order]
    a, b = np.searchsorted(who, no, side="left"), np.searchsorted(who, no, side="right")
    n = b - a
    answer = np.repeat(np.arange(len(no)), n)
    row = np.repeat(a, n) + np.arange(len(answer)) - np.repeat(np.cumsum(n) - n, n)
    ok = least[answer] < ids[doc[row]]
    answer, row = answer[ok], row[ok]
    return doc[row], place[row] + since[answer], place[row] + until[answer] + WINDOW


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Step 4: merged spans of each text and the words left."""
    ids, spans, kept, sizes = [], [], [], []
    for i, (_, own, texts, (told,)) in enumerate(each_chunk(batch)):
        doc, start, end = _intervals(own, told or [])
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
        at = np.searchsorted(doc, np.arange(len(texts) + 1))
        ids += batch.column(1)[i].as_py()
        for k, text in enumerate(texts):
            words = text.split()
            merged: list[list[int]] = []
            for s, e in zip(start[at[k]:at[k + 1]].tolist(), end[at[k]:at[k + 1]].tolist(), strict=True):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            sizes.append(len(words))
            spans.append([{"start": s, "end": e} for s, e in merged])
            edges = [0, *(x for m in merged for x in m), len(words)]
            kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_words", "spans", "kept"])


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_entries: int = MOST_ENTRIES) -> DataFrame:
    """``(doc_id, n_words, spans, kept)``, a row for each row of ``docs``.

    Words are what the six ASCII white-space characters part. ``spans``: the maximal
    removed runs of words as (start, end), end exclusive; ``kept``: the other words
    joined by one space, as UTF-8. Null and empty texts have no words; texts under
    ``WINDOW`` words keep all. A null id counts as larger than any other; rows of one
    id don't remove each other's words. Repeated rows and ties give each row its
    own result; extra columns are not read, an empty table gives an empty one.
    """
    spark = docs.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = 2 * tasks
    chunks = chunk_table(id_text(docs, id_col, text_col), tasks)
    anchors = map_batches(chunks, _anchor_rows(buckets), PARTS)
    dealt = anchors.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    told = settle(map_stream(dealt, _shared_anchors, "chunk long, n long, payload binary"), "shared-anchors")
    share = (told.agg(F.sum("n")).first()[0] or 0) // (4 * buckets)
    own = told.groupBy("chunk").agg(F.collect_list("payload").alias("told"))  # a chunk's own anchors
    rows = map_batches(chunks.join(own, "chunk").select("chunk", "ids", "sizes", "data", "told"), _entry_rows(buckets, min(most_entries, max(LEAST_ENTRIES, share))), PARTS)
    shards = rows.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    answers = settle(map_stream(shards, _shard_answers, "chunk long, kind int, payload binary"), "passage-answers")
    mine = answers.groupBy("chunk").agg(F.collect_list(F.struct("kind", "payload")).alias("told"))
    whole = chunks.join(mine, "chunk", "left").select("chunk", "ids", "sizes", "data", "told")
    return map_batches(whole, _cut, "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept binary")
