"""Byte-level BPE by backtracking over longest matches.

Token bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton
over strings finds the longest token that starts at each byte in one pass. A
piece is encoded from left to right: take the longest token that is compatible
with the one before it, fall back to its next shorter prefix, and step back
where none fits. Two adjacent tokens are compatible if the merges, applied to
their bytes together, give these two again; a sequence whose neighbours are all
compatible is the merges' own result. Compatibility is memoised per pair, and
each byte offset is given up at most once, so a piece takes linear time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import id_text, map_batches

#: Pieces of at most so many bytes are remembered, and pairs of tokens. A store that
#: is full becomes the older generation; what is used again moves to the new one.
MEMO_PIECES, MEMO_PAIRS = 200_000, 150_000
MEMO_BYTES = 64
PIECES = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(ranks: dict[bytes, int], data: bytes) -> list[int]:
    """The merges by definition: join the adjacent pair of least rank, leftmost first."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], len(ranks) + 1), i) for i in range(len(parts) - 1))
        if rank > len(ranks):
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class ByteBPE:
    """Encoder and decoder of one rank file under one piece pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.digits = {i: str(i) for i in self.bytes_of}
        self.pattern = regex.compile(pattern)
        self.chars = {b.decode("latin-1"): i for b, i in ranks.items()}
        self.auto = ahocorasick.Automaton()
        for s, i in self.chars.items():
            self.auto.add_word(s, (len(s), i))
        self.auto.make_automaton()
        self.size = {i: len(b) for b, i in ranks.items()}
        self.shorter: dict[int, int | None] = {}
        self.pairs: dict[int, bool] = {}
        self.old_pairs: dict[int, bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.old_memo: dict[str, tuple[int, ...]] = {}

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self.shorter:
            b = self.bytes_of[token]
            self.shorter[token] = next((self.ranks[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in self.ranks), None)
        return self.shorter[token]

    def _fits(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            known = self.old_pairs.get(key)
            if known is None:
                known = merge(self.ranks, self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs, self.old_pairs = {}, self.pairs
            self.pairs[key] = known
        return known

    def encode_bytes(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None or not data:
            return [] if whole is None else [whole]
        n, text = len(data), data.decode("latin-1")
        longest: list[int | None] = [None] * n
        for end, (k, token) in self.auto.iter(text):
            longest[end - k + 1] = token  # later matches from one start are longer
        out: list[int] = []
        given_up = bytearray(n + 1)
        at, token, last = 0, longest[0], -1
        size, shorter, pairs, fits = self.size, self.shorter, self.pairs.get, self._fits
        while True:
            while token is not None:
                if not given_up[at + size[token]]:
                    if last < 0:
                        break
                    ok = pairs(last << 32 | token)
                    if ok or (ok is None and fits(last, token)):
                        break
                token = shorter[token] if token in shorter else self._shorter(token)
            if token is not None:
                out.append(token)
                at += size[token]
                if at == n:
                    return out
                last, token = token, longest[at]
            else:
                if not out:
                    raise ValueError("the ranks don't cover every byte")
                given_up[at] = 1
                back = out.pop()
                at -= size[back]
                last = out[-1] if out else -1
                token = self._shorter(back)

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.memo.get(piece) or self.old_memo.get(piece)
        if ids is None:
            ids = tuple(self.encode_bytes(piece.encode()))
        if len(piece) <= MEMO_BYTES:
            if len(self.memo) >= MEMO_PIECES:
                self.memo, self.old_memo = {}, self.memo
            self.memo[piece] = ids
        return ids

    def encode_stream(self, text: str) -> Iterator[list[int]]:
        """Ids in runs of a bounded number of pieces."""
        known, piece = self.memo.get, self._piece
        found = (m.group() for m in self.pattern.finditer(text)) if len(text) > 16 * PIECES else iter(self.pattern.findall(text))
        while some := list(islice(found, PIECES)):
            ids: list[int] = []
            for p in some:
                ids += known(p) or piece(p)
            yield ids

    def encode(self, text: str) -> list[int]:
        return [i for run in self.encode_stream(text) for i in run]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> ByteBPE:
    """One encoder for each worker process and rank file."""
    return ByteBPE(read_ranks(path), pattern)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, a row for each row of ``docs``.

    Encodes every whole text and decodes the ids again. ``ids_sha256`` hashes the
    decimal ids joined by one space, ``decoded_sha256`` the decoded bytes. Null
    and empty texts have no ids and the hashes of nothing. Ids may be null or
    repeat; extra columns are not read. Long texts pass in runs of pieces.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(path, pattern)
        counts, ids_hash, text_hash = [], [], []
        digits, bytes_of = bpe.digits.__getitem__, bpe.bytes_of.__getitem__
        for text in batch.column(1).to_pylist():
            n, a, b = 0, hashlib.sha256(), hashlib.sha256()
            for ids in bpe.encode_stream(text or ""):
                a.update(((" " if n else "") + " ".join(map(digits, ids))).encode())
                b.update(b"".join(map(bytes_of, ids)))
                n += len(ids)
            counts.append(n)
            ids_hash.append(a.hexdigest())
            text_hash.append(b.hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(id_text(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the ids themselves as an array; null and empty texts give an empty one."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(path, pattern)
        ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_batches(id_text(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, text)`` of what ``encode`` returned; null ids count as none, bytes that are no UTF-8 become U+FFFD."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(path, pattern)
        texts = [bpe.decode(ids or []).decode(errors="replace") for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select(F.col("doc_id"), F.col("ids")), run, "doc_id long, text string")
