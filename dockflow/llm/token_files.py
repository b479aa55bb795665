"""Token-id files with Elias-Fano document boundaries.

Ids of all documents, in ascending id order, form one long array that is cut
into shards of whole documents. A shard holds its ids as fixed-width integers
(two bytes where the vocabulary allows, else four) and the ends of its documents
as an Elias-Fano sequence: low bits packed, high bits in unary, with the place of
every 64th one sampled for select. That is about ``2 + log2(ids / documents)``
bits a document; no table of 64-bit offsets is stored. Shards are the rows of a
Parquet dataset, so that Spark's committer writes them on any file system and
lost executors cost a task only.

Shard payload, little-endian: magic ``EFID``, u8 id width, u8 low-bit count, u16
zero, u64 documents, u64 ids, u64 bytes of low bits, u64 bytes of high bits; then
low bits, high bits, u32 samples, ids.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dockflow.llm.base import id_text, map_batches, map_stream, text_bytes

MAGIC = b"EFID"
HEAD = struct.Struct("<4sBBHQQQQ")
SAMPLE = 64
SHARD_IDS = 1 << 20
FIRST = -(1 << 63)
#: Distinct words and pieces that a worker remembers. A store that is full becomes
#: the older generation; what is used again moves to the new one.
MEMO_WORDS, MEMO_PIECES = 350_000, 450_000
PLAIN = re.compile(rb"[!-~]+").fullmatch
SHARD_SCHEMA = "part long, seq int, start long, n_docs long, n_ids long, doc_ids array<long>, payload binary"


class EliasFano:
    """A non-decreasing sequence of whole numbers with select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        if bits:
            each = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(each.astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.empty(0, np.uint8)
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(at[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        unary[at] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little"), at[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """The i-th value: from the sampled one before it, walk words and then one word's bits."""
        words = self.high.view("<u8")
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        word = at // 64
        bits = int(words[word]) >> (at % 64) << (at % 64)
        while left >= bits.bit_count():
            left -= bits.bit_count()
            word += 1
            bits = int(words[word])
        for _ in range(left):
            bits &= bits - 1
        high = word * 64 + (bits & -bits).bit_length() - 1 - i
        if not self.low_bits:
            return high
        at = i * self.low_bits
        some = self.low[at // 8:(at + self.low_bits + 7) // 8].tobytes()
        return (high << self.low_bits) | ((int.from_bytes(some, "little") >> (at % 8)) & ((1 << self.low_bits) - 1))

    def all(self) -> np.ndarray:
        """Every value at once."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n].astype(np.int64)
        values = (at - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            each = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
            values |= each.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return values


def pack_shard(ids: list[bytes], width: int) -> bytes:
    """The payload of the documents whose little-endian ids these are."""
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    ef = EliasFano.build(ends)
    total = int(ends[-1]) if len(ends) else 0
    head = HEAD.pack(MAGIC, width, ef.low_bits, 0, ef.n, total, len(ef.low), len(ef.high))
    return b"".join([head, ef.low.tobytes(), ef.high.tobytes(), ef.samples.tobytes(), *ids])


def open_shard(payload: bytes) -> tuple[EliasFano, np.ndarray]:
    """The document ends and the ids of a payload, without copying the ids."""
    magic, width, bits, _, n, total, low, high = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a shard of token ids")
    at, raw = HEAD.size, np.frombuffer(payload, np.uint8)
    k = -(-n // SAMPLE)
    ef = EliasFano(n, bits, raw[at:at + low], raw[at + low:at + low + high].copy(), np.frombuffer(payload, "<u4", k, at + low + high))
    return ef, np.frombuffer(payload, f"<u{width}", total, at + low + high + 4 * k)


class WordEncoder:
    """Ids of texts by one tokenizer file, each distinct word encoded once.

    The file's vocabulary drops white space and never joins across it, so words
    between ASCII white space are independent. Words of printable ASCII are cut
    further, by the file's own piece pattern, and their pieces go through the
    library's model; from others a final full stop or comma is cut, and the rest
    goes through the whole library. The library looks for its added tokens
    (``<|endoftext|>``) before all this, anywhere in a text: a text that holds one
    goes through it as a whole.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.model, self.kind = self.tok.model, {2: "H", 4: "I"}[width]
        splits = json.loads(self.tok.to_str())["pre_tokenizer"]["pretokenizers"]
        self.pieces_of = regex.compile(splits[0]["pattern"]["Regex"]).findall
        added = [t.content.encode().lower() for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added)), re.IGNORECASE).search if added else lambda text: None
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.pieces: dict[bytes | str, bytes] = {}
        self.old_pieces: dict[bytes | str, bytes] = {}

    def _pack(self, ids: Iterable[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            known = self.old_pieces.get(piece)
            if known is None:
                known = self._pack([t.id for t in self.model.tokenize(piece)])
            self.pieces[piece] = known
        return known

    def _learn(self, words: set[bytes]) -> None:
        if len(self.pieces) > MEMO_PIECES:
            self.pieces, self.old_pieces = {}, self.pieces
        rest = []
        for w in words:
            core = w.rstrip(b".,")
            if core.isalpha():  # letters of ASCII only
                ids = self._piece(core.decode().lower())
                self.words[w] = ids + self._piece(w[len(core):].decode()) if len(core) < len(w) else ids
            elif PLAIN(w):
                self.words[w] = b"".join(map(self._piece, self.pieces_of(w.decode().lower())))
            else:
                rest.append((w, core if core and core.decode()[-1].lower()[-1].isalpha() else w))
        for _, c in rest:
            if c not in self.pieces and c in self.old_pieces:
                self.pieces[c] = self.old_pieces[c]
        new = list({c for _, c in rest if c not in self.pieces})
        for c, e in zip(new, self.tok.encode_batch_fast([c.decode() for c in new], add_special_tokens=False), strict=True):
            self.pieces[c] = self._pack(e.ids)
        for w, c in rest:
            self.words[w] = self.pieces[c] + (self._piece(w[len(c):].decode()) if len(c) < len(w) else b"")

    def encode(self, text: bytes) -> bytes:
        """Packed ids of a whole text."""
        if self.added(text):
            return self._pack(self.tok.encode(text.decode(), add_special_tokens=False).ids)
        words = text.split()
        ids = list(map(self.words.get, words))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            new = {words[i] for i in missing}
            if len(self.words) > MEMO_WORDS:
                self.words, self.old_words = {}, self.words
            known = {w: self.old_words[w] for w in new if w in self.old_words}
            self.words.update(known)
            self._learn(new.difference(known))
            for i in missing:
                ids[i] = self.words[words[i]]
        return b"".join(ids)


@lru_cache(maxsize=2)
def _encoder(path: str, width: int) -> WordEncoder:
    """One encoder for each worker process, tokenizer file and width."""
    return WordEncoder(path, width)


def id_width(path: str, end_id: int) -> int:
    return 2 if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def _buckets(bounds: np.ndarray, ids: pa.Array, rows: np.ndarray) -> np.ndarray:
    """Ranges of ids in their order; rows of an id that is several bounds are spread over all its ranges."""
    own = np.array([FIRST if x is None else x for x in ids.to_pylist()], np.int64)
    low, high = np.searchsorted(bounds, own, side="left"), np.searchsorted(bounds, own, side="right")
    some = (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return low + (some % (high - low + 1).astype(np.uint64)).astype(np.int64)


def token_ids(docs: DataFrame, path: str, end_id: int, width: int, bounds: np.ndarray) -> DataFrame:
    """``(doc_id, row, bucket, ids)`` of ``(doc_id, text, row)``: little-endian ids of each text and the end id."""
    end = int(end_id).to_bytes(width, "little")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = _encoder(path, width).encode
        out = [encode(t) + end for t in text_bytes(batch.column(1))]
        bucket = _buckets(bounds, batch.column(0), batch.column(2).to_numpy())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bucket), pa.array(out, pa.binary())], ["doc_id", "row", "bucket", "ids"])

    return map_batches(docs, run, "doc_id long, row long, bucket long, ids binary")


def write_token_files(docs: DataFrame, out_path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Write ``docs`` as shards in ascending id order under ``out_path``.

    Null and empty texts are documents of the end id alone; null ids come first;
    rows of one id come in an arbitrary order. A text longer than ``shard_ids`` is
    a shard of its own. No rows write an empty dataset. Extra columns are not read.

    Texts are encoded once and shuffled once, as ids: the ranges are quantiles of
    the ids, taken beforehand (range partitioning would encode to sample).
    """
    width = id_width(tokenizer_path, end_id)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = id_text(docs, id_col, text_col)
    ranges = 4 * tasks  # several a task, so that tasks are even though ranges are dealt by hash
    shares = F.array(*(F.lit(k / ranges) for k in range(1, ranges)))
    found = rows.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(FIRST)), shares, F.lit(10 * ranges)).alias("q")).first().q
    encoded = token_ids(rows.withColumn("row", F.monotonically_increasing_id()), tokenizer_path, end_id, width, np.array(found or [], np.int64))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bucket, seq, start, size = -1, 0, 0, 0
        ids: list[bytes] = []
        own: list[int | None] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket]), pa.array([seq], pa.int32()), pa.array([start]), pa.array([len(ids)]), pa.array([size]), pa.array([own], pa.list_(pa.int64())), pa.array([pack_shard(ids, width)], pa.binary())],
                ["part", "seq", "start", "n_docs", "n_ids", "doc_ids", "payload"])

        for batch in batches:
            for b, doc, data in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                n = len(data) // width
                if ids and (b != bucket or size + n > shard_ids):
                    yield flush()
                    seq, start = seq + 1, start + size
                    ids, own, size = [], [], 0
                if b != bucket:
                    bucket, seq, start = b, 0, 0
                ids.append(data)
                own.append(doc)
                size += n
        if ids:
            yield flush()

    ordered = encoded.repartition(tasks, "bucket").sortWithinPartitions("bucket", "doc_id", "row").select("bucket", "doc_id", "ids")
    map_stream(ordered, shards, SHARD_SCHEMA).write.option("compression", "zstd").parquet(out_path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document in the shards under ``path``.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is over
    the ids as little-endian unsigned 32-bit integers.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[list] = [[], [], [], [], []]
        for part, base, docs, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "start", "doc_ids", "payload")), strict=True):
            ef, ids = open_shard(payload)
            ends = np.array([ef.select(i) for i in range(ef.n)], np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            wide = ids.astype("<u4")
            rows[0] += docs
            rows[1] += [part] * len(docs)
            rows[2] += (starts + base).tolist()
            rows[3] += (ends - starts).tolist()
            rows[4] += [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        kinds = [pa.int64()] * 5
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], ["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    own = map_batches(shards.select("part", "start", "doc_ids", "payload"), run, "doc_id long, part long, at long, n_tokens long, ids_crc32 long")
    # One row for each range of ids: a few times the number of tasks, whatever the number of documents.
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return own.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
