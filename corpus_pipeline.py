"""The corpus pipeline: five filters over ``documents``, each on what its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``; the
last returns token ids. ``run`` writes each stage's result as Parquet under the
shared checkpoint folder and reads it again, so that an executor that is lost
costs tasks of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm.base import free_name, settle, table
from dockflow.llm.byte_bpe import encode
from dockflow.llm.decontaminate import add_hits
from dockflow.llm.secret_scan import redact
from dockflow.llm.simhash import keep_one
from dockflow.llm.toxicity import add_scores, fit_model

TOXIC_AT = 0.3
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC_AT``; every score is known, so null texts stay.

    Repeated rows have one score; all columns stay as they are, whatever their names.
    """
    score = free_name(docs, "toxicity_score")
    model = fit_model(docs, table(spark, sf_dir, "labels"))
    return add_scores(docs, model, score_col=score).where(F.col(score) < TOXIC_AT).drop(score)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each SimHash group (three-word shingles, three bits); of rows that repeat an id, one."""
    return keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item, exact or edited.

    Null and empty texts hold none; repeated rows go or stay together; all columns
    stay as they are, whatever their names. Without test items all documents stay.
    """
    hits = free_name(docs, "benchmark_hits")
    return add_hits(docs, table(spark, sf_dir, "benchmark"), hits_col=hits).where(F.size(hits) == 0).drop(hits)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask, ``n_chars`` counted anew where a text changed.

    Null texts stay null; repeated rows stay alike; the other columns stay as they
    are, whatever their names.
    """
    before = free_name(docs, "text_before")
    clean = redact(docs.withColumn(before, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(before))
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop(before)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_tokens)``: byte-level BPE ids of every text left.

    Null and empty texts have an empty array and 0 tokens; repeated rows have a row
    each, null ids stay null; other columns are not read.
    """
    encoded = encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark),
    ("secret_scan", secrets),
    ("byte_bpe_encoding", token_ids),
]

#: No stage but the fixed patterns of the secret scan can be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
