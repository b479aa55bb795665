"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import url_templates
from dockflow.llm.base import table
from dockflow.llm.byte_bpe import round_trip
from dockflow.llm.conversation_repair import repair
from dockflow.llm.decontaminate import contaminated
from dockflow.llm.page_text import main_text
from dockflow.llm.phrase_automata import remove_passages
from dockflow.llm.secret_scan import KINDS, listed, scan
from dockflow.llm.simhash import near_duplicates
from dockflow.llm.sql import OP11_SQL, OP12_SQL, op9_sql, op10_sql, op13_sql
from dockflow.llm.suffix_dedup import remove_repeats
from dockflow.llm.token_files import read_token_files, write_token_files
from dockflow.llm.toxicity import add_scores, fit_model, held_out
from dockflow.llm.url_templates import judge
from dockflow.llm.vector_codes import vector_codes
from dockflow.llm.vector_links import near_vectors
from dockflow.session import scratch_path

TOXIC_AT = 0.3
# The rules of the url query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), URL_RULES).drop("blocked_share")



def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    removed = (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed")
    return cut.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op5_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = add_scores(docs, fit_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(listed(KINDS[:3]).cast("binary"), 256).alias("base_sha256"), listed(KINDS).alias("spans"))


def op11_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_passages(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed")
    return cut.select("doc_id", "n_words", removed, F.sha2("kept", 256).alias("kept_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` rows with the faults that the repair query is about, set by a checksum of ``conv_id:turn``."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(word("role"))
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = repair(damaged(rows))
    key = lambda df, name: df.withColumnRenamed("conv_id", name)
    out = rows.select("conv_id").distinct()
    out = out.join(key(done.summary(), "_a"), F.col("conv_id").eqNullSafe(F.col("_a")), "left")
    out = out.join(key(done.digests(), "_b"), F.col("conv_id").eqNullSafe(F.col("_b")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op13_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", "codebooks_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_url_templates, op2_token_files, op3_suffix_dedup, op4_page_difference, op5_embedding_dups, op6_toxicity, op7_decontaminate, op8_byte_bpe, op9_simhash, op10_secret_battery, op11_phrase_automata, op12_conversation_repair, op13_orchard_codes, pipeline)
    return {f.__name__: f for f in found}


OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d WHERE n >= 50)),
first AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
hit AS (SELECT w.doc_id, w.p FROM w JOIN first USING (s) WHERE first.least < w.doc_id),
run AS (
  SELECT doc_id, p, SUM(CASE WHEN p - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS r
  FROM (SELECT doc_id, p, LAG(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM hit)
),
span AS (SELECT doc_id, MIN(p) AS a, MAX(p) + 50 AS b FROM run GROUP BY doc_id, r),
piece AS (
  SELECT doc_id, COALESCE(LAG(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since, a AS until FROM span
  UNION ALL SELECT d.doc_id, COALESCE((SELECT MAX(b) FROM span WHERE span.doc_id = d.doc_id), 0), d.n FROM d
),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (until - since)), '' ORDER BY since) AS k FROM piece JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - length(k) // 2 AS BIGINT) AS n_removed,
  (SELECT COUNT(*) FROM span WHERE span.doc_id = d.doc_id) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id)
"""

OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x, embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0 AS ok
  FROM embeddings
),
u AS (SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS norm FROM v WHERE ok),
link AS (
  SELECT a.vec_id AS p, b.vec_id AS q FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.93
),
reach AS (SELECT vec_id AS p, vec_id AS q FROM v UNION SELECT reach.p, link.q FROM reach JOIN link ON reach.q = link.p),
least AS (SELECT p, MIN(q) AS component_id FROM reach GROUP BY p),
n AS (SELECT p, COUNT(*) AS n FROM link GROUP BY p)
SELECT v.vec_id, COALESCE(n.n, 0) AS n_links, least.component_id, v.vec_id = least.component_id AS kept
FROM v JOIN least ON least.p = v.vec_id LEFT JOIN n ON n.p = v.vec_id
"""


def op1_sql(rules: list[tuple[str, str]] = URL_RULES) -> str:
    """Rules, template tree and purities of the url query; one pair of steps for each level of the tree."""
    upper = url_templates.UPPER
    fits = [
        (f"(host = '{rule.partition('/')[0]}' OR ends_with(host, '.{rule.partition('/')[0]}')) AND starts_with(path, '/{rule.partition('/')[2]}')", says, rule)
        for says, rule in sorted(rules, key=lambda r: -len(r[1]))
    ]
    cases = lambda k: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[k]}'" for f in fits) + " END"
    levels = "".join(f"""
c{d} AS (SELECT host, t, segs[{d + 1}] AS seg, COUNT(*) AS n FROM p{d} WHERE len(segs) > {d} GROUP BY ALL),
l{d} AS (
  SELECT host, t, seg FROM (SELECT *, SUM(n) OVER (PARTITION BY host, t) AS total FROM c{d})
  WHERE n >= {url_templates.SUPPORT} AND n * n >= total
),
p{d + 1} AS (
  SELECT p.* EXCLUDE (t), CASE WHEN len(segs) > {d} THEN list_append(p.t, COALESCE(l.seg, '*')) ELSE p.t END AS t
  FROM p{d} p LEFT JOIN l{d} l ON p.host = l.host AND p.t = l.t AND p.segs[{d + 1}] = l.seg
),""" for d in range(url_templates.DEPTH + 1))
    top = url_templates.DEPTH + 1
    alike = f"""tl > l AND abs(b / l - (tb - b) / (tl - l)) <= {url_templates.ALIKE} * sqrt(tb / tl * (1 - tb / tl) * (1 / l + 1 / (tl - l)))
  QUALIFY COUNT(*) OVER (PARTITION BY host, shape) > 1"""
    mark = lambda d, m: f"list_transform(unit, lambda s, i: CASE WHEN i = {d + 1} THEN {m} ELSE s END)"
    sums = "SUM(l) OVER (PARTITION BY host, shape) AS tl, SUM(b) OVER (PARTITION BY host, shape) AS tb"
    merges = "".join(f"""
w{d} AS (
  SELECT host, unit, SUM(labelled) AS l, SUM(blocked) AS b, {mark(d, "'?'")} AS shape
  FROM u{d + 1} WHERE len(unit) > {d} AND unit[{d + 1}] <> '*' AND NOT starts_with(unit[{d + 1}], '?')
  GROUP BY host, unit HAVING SUM(labelled) >= {url_templates.LABELS}
),
s{d} AS (SELECT *, {sums} FROM w{d}),
k{d} AS (SELECT * FROM s{d} WHERE {alike}),
v{d} AS (
  SELECT host, unit, l, b, {mark(d, "CASE WHEN b / l >= tb / tl THEN '?+' ELSE '?-' END")} AS shape
  FROM s{d} WHERE NOT EXISTS (SELECT 1 FROM k{d} k WHERE k.host = s{d}.host AND k.unit = s{d}.unit)
),
y{d} AS (SELECT *, {sums} FROM v{d}),
z{d} AS (SELECT host, unit, shape FROM k{d} UNION ALL SELECT host, unit, shape FROM (SELECT * FROM y{d} WHERE {alike})),
u{d} AS (SELECT u.* EXCLUDE (unit), COALESCE(z.shape, u.unit) AS unit FROM u{d + 1} u LEFT JOIN z{d} z ON z.host = u.host AND z.unit = u.unit),""" for d in reversed(range(top)))
    return f"""
WITH url AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw_host, rest FROM url),
hp AS (SELECT page_id, translate(raw_host, '{upper}', '{upper.lower()}') AS host, regexp_extract(substr(rest, length(raw_host) + 1), '^([^?#]*)', 1) AS path FROM cut),
parts AS (SELECT *, {cases(2)} AS rule, {cases(1)} AS says, list_filter(string_split(path, '/'), lambda s: s <> '') AS whole FROM hp),
p0 AS (
  SELECT * EXCLUDE (whole), CAST([] AS VARCHAR[]) AS t, CASE WHEN len(whole) > {url_templates.DEPTH}
    THEN list_append(whole[1:{url_templates.DEPTH}], array_to_string(whole[{url_templates.DEPTH + 1}:], '/')) ELSE whole END AS segs
  FROM parts
),{levels}
u{top} AS (
  SELECT host, t, t AS unit, CAST(COUNT(says) AS DOUBLE) AS labelled, CAST(COUNT(*) FILTER (WHERE says = 'block') AS DOUBLE) AS blocked FROM p{top} GROUP BY host, t
),{merges}
world AS (SELECT CASE WHEN SUM(labelled) > 0 THEN SUM(blocked) / SUM(labelled) ELSE 0 END AS prior FROM u0),
judged AS (
  SELECT host, t, (SUM(blocked) OVER w + {url_templates.SMOOTHING} * (SELECT prior FROM world)) / (SUM(labelled) OVER w + {url_templates.SMOOTHING}) AS blocked_share
  FROM u0 WINDOW w AS (PARTITION BY host, unit)
)
SELECT page_id, p.host, path, rule, COALESCE(says, CASE WHEN blocked_share >= {url_templates.REJECT_AT} THEN 'block' ELSE 'allow' END) AS verdict,
  '/' || array_to_string(p.t, '/') AS template
FROM p{top} p JOIN judged ON judged.host = p.host AND judged.t = p.t
"""


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express; the others are tested by brute force in tests/llm."""
    return {"op1_url_templates": op1_sql(), "op3_suffix_dedup": OP3_SQL, "op5_embedding_dups": OP5_SQL, "op9_simhash": op9_sql(), "op10_secret_battery": op10_sql(), "op11_phrase_automata": OP11_SQL, "op12_conversation_repair": OP12_SQL, "op13_orchard_codes": op13_sql()}
