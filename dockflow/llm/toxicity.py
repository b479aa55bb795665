"""Toxicity by compression distance between two zstandard dictionaries.

Both dictionaries hold the same sample of ordinary text; the toxic one holds, in
front of it, passages that are typical of toxic documents: maximal runs of byte
n-grams that labelled toxic documents contain far more often than ordinary ones.
Each window of a text is compressed under either dictionary. What the toxic one
saves is the window's evidence; counts of windows beyond several thresholds, the
largest savings and their mean are calibrated to a probability on labelled
documents that no dictionary has seen.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from dockflow.llm.base import map_batches, text_bytes

#: The model is fitted on at most so many labelled documents of each class, of at
#: most so many bytes each, taken in the order of a hash of their ids.
SAMPLE_ROWS = {1: 2000, 0: 4000}
SAMPLE_BYTES = 16_000
GRAMS = (4, 6, 8)
BASE_BYTES = 8192
TOXIC_BYTES = 8192
THRESHOLDS = (1, 2, 3, 4, 5)
WINDOW = re.compile(rb"(?s).{1,40}\S{0,64}\s{0,8}")
#: Starts every window and ends both dictionaries, so that zstandard always writes a compressed block.
MARK = bytes(range(128, 160))
SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def _grams(b: bytes) -> set[bytes]:
    return {b[i:i + n] for n in GRAMS for i in range(len(b) - n + 1)}


def enriched(toxic: list[bytes], ordinary: list[bytes]) -> dict[bytes, float]:
    """n-grams in significantly more toxic documents: 6 standard errors, odds of e**1.5."""
    counts = Counter(g for b in toxic for g in _grams(b))
    hits = {g: k for g, k in counts.items() if k >= 5}
    other = Counter(g for b in ordinary for g in _grams(b) & hits.keys())
    p, q, out = len(toxic), len(ordinary), {}
    for g, k in hits.items():
        m = other[g]
        mean = (k + m) * p / (p + q)
        z = (k - mean) / np.sqrt(mean * q / (p + q) + 1e-9)
        if z > 6 and np.log((k + 0.5) / (p + 1) * (q + 1) / (m + 0.5)) > 1.5:
            out[g] = float(z)
    return out


def typical_runs(toxic: list[bytes], grams: dict[bytes, float]) -> bytes:
    """Maximal runs covered by ``grams`` in two documents or more, frequent ones first, each adding new grams."""
    runs: Counter[bytes] = Counter()
    for b in toxic:
        cover = bytearray(len(b))
        for n in GRAMS:
            for i in range(len(b) - n + 1):
                if b[i:i + n] in grams:
                    cover[i:i + n] = b"\1" * n
        runs.update({b[m.start():m.end()] for m in re.finditer(rb"\x01+", bytes(cover))})
    seen: set[bytes] = set()
    out, size = [], 0
    for run, k in sorted(runs.items(), key=lambda x: (-x[1], len(x[0]), x[0])):
        own = _grams(run) & grams.keys()
        if k < 2 or len(own - seen) < max(1, len(own) // 3) or size + len(run) > TOXIC_BYTES:
            continue
        out.append(run)
        seen |= own
        size += len(run) + 1
    return b"\0".join(out)


@dataclass
class Model:
    """Two dictionaries and the calibration; small enough to go with each task."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: list[float] = field(default_factory=list)

    def compressors(self) -> tuple[zs.ZstdCompressor, zs.ZstdCompressor]:
        params = zs.ZstdCompressionParameters(window_log=17, hash_log=17, chain_log=17, search_log=7, min_match=4, target_length=64, strategy=zs.STRATEGY_LAZY2, write_content_size=0, write_checksum=0, write_dict_id=0)
        out = []
        for content in (self.ordinary, self.toxic):
            d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            out.append(zs.ZstdCompressor(dict_data=d, compression_params=params))
        return out[0], out[1]

    def features(self, text: bytes, pair: tuple[zs.ZstdCompressor, zs.ZstdCompressor]) -> list[float]:
        plain, toxic = pair[0].compress, pair[1].compress
        saved = np.array([len(plain(w)) - len(toxic(w)) for w in (MARK + b" " + m for m in WINDOW.findall(text.translate(SPACES)))], float)
        if not len(saved):
            return [0.0] * (len(THRESHOLDS) + 4)
        top = np.partition(saved, -2)[-2:] if len(saved) > 1 else np.array([0.0, saved[0]])
        return [float(top[1]), float(top[0]), *(float(np.log1p((saved >= t).sum())) for t in THRESHOLDS), float(saved.mean()), float(np.log1p(len(saved)))]

    def probability(self, features: list[list[float]]) -> np.ndarray:
        if not self.weights or not features:
            return np.zeros(len(features))
        x = np.c_[np.array(features), np.ones(len(features))]
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Weighted ridge logistic regression by Newton steps."""
    x, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    ridge = 1e-2 * np.eye(len(w))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hess + 1e-6 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def train(rows: list[tuple[bytes, int]], counts: dict[int, int]) -> Model:
    """Dictionaries from the first half of each class, calibration on the second.

    ``counts``: labelled documents of each class in all, which the calibration
    restores. Without two documents of each class nothing is known to be toxic,
    and every score is 0.
    """
    by = {c: [b.translate(SPACES) for b, y in rows if y == c] for c in (0, 1)}
    fit = {c: x[: (len(x) + 1) // 2] for c, x in by.items()}
    check = {c: x[(len(x) + 1) // 2:] for c, x in by.items()}
    if not check[0] or not check[1]:
        return Model()
    rng = np.random.default_rng(1)
    words = [w for b in fit[0] for w in b.split()]
    base = b" ".join(words[i] for i in rng.permutation(len(words))[:BASE_BYTES])[:BASE_BYTES]
    runs = typical_runs(fit[1], enriched(fit[1], fit[0]))
    model = Model(b" " + runs + b" " + base + b" " + MARK, base + b" " + MARK)
    pair = model.compressors()
    x = np.array([model.features(b, pair) for c in (0, 1) for b in check[c]])
    y = np.repeat([0.0, 1.0], [len(check[0]), len(check[1])])
    weight = np.where(y == 1, counts[1] / len(check[1]), counts[0] / len(check[0]))
    model.weights = _calibrate(x, y, weight / weight.mean())
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept out of every fit: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from a bounded sample of the labelled documents that aren't held out.

    The sample is ``SAMPLE_ROWS`` ids of each class by hash order; texts over
    ``SAMPLE_BYTES`` and null labels are left out. An id with labels of both
    kinds counts as toxic; of rows that share an id all texts count.
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
        .where("id is not null and y in (0, 1)").where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
    )
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("id")
    some = [known.where(F.col("y") == c).orderBy(order, "id").limit(n) for c, n in SAMPLE_ROWS.items()]
    ids = F.broadcast(some[0].unionByName(some[1]))  # at most the rows of SAMPLE_ROWS
    texts = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
        .where(F.octet_length("t") <= SAMPLE_BYTES).join(ids, "id")
        .orderBy(order, "id", F.xxhash64("t")).limit(2 * sum(SAMPLE_ROWS.values()))
    )
    return train([(r.t.encode(), r.y) for r in texts.select("t", "y").collect()], counts)


def add_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability that a whole text is toxic.

    Null and empty texts are scored like texts without a window. All columns
    stay, and every row gets its score; ``score_col`` must be a new name.
    """
    if score_col in docs.columns:
        raise ValueError(f"{score_col} is a column already")
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, StructField(score_col, DoubleType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pair = model.compressors() if model.weights else None
        texts = text_bytes(batch.column(at))
        scores = model.probability([model.features(t, pair) if pair else [] for t in texts])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, score_col])

    return map_batches(docs, run, schema)
