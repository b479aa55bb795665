"""URL filter, page text, vectors and tokenizers against brute force and the libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dockflow.llm import byte_bpe, page_text, token_files, url_templates, vector_links
from dockflow.llm.queries import URL_RULES, op1_sql

from ..conftest import SF_SMALL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    "a\x1cb", "a\x0bb", "a\xa0b\u2028c", "don't Don'T we'll'x 'S 'RE", "\u0301a \u00e1 a\u0301 b \u0301c e\u0301", "<|endoftext|> x <|startoftext|>y", "İSTANBUL! İ. Σίσυφος ΣΑΣ",
    "", "  ", "é., á. ,., x.,é 12é34. ﷺ,", "K’s ‘s «é»., 日本語.", "1234 a1b2--c__d", "\x00a \x7f é́.", "a" * 3000, "ab" * 2000 + " é" * 500, "\n\n  \t x",
]


# --- URL filter ------------------------------------------------------------

def rule_brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    host, path = m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]
    best = None
    for says, rule in URL_RULES:
        name, _, prefix = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix) and (best is None or len(rule) > len(best[1])):
            best = (says, rule)
    return host, path, best and best[1], best and best[0]


ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?y=/de/", "x://org", "x://org/", "x://notorg/", "a://b://example.org/es/", "http://example.org/en/12#/x",
    "http://example.com/fr", "http://example.com/fr/", "http://example.org:80/es/", "http://ÉCOLE.com/de/ü", "http://h.net//a//b/", "http://h.net/?q", "http://h.net#f/g",
]


def test_rules_match_brute_force(spark):
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    pages += [(1000 + i, u) for i, u in enumerate(ODD_URLS)] + [(1000, None), (None, "x://org/")]
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in pages], "page_id long, url string, template string, host int")
    got = url_templates.judge(df, URL_RULES).collect()
    want = sorted(((i, *rule_brute(u)[:3]) for i, u in pages), key=repr)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=repr) == want
    says = dict((tuple(w), None) for w in want)
    assert says and all(r.verdict == dict((rule, s) for s, rule in URL_RULES)[r.rule] for r in got if r.rule)
    assert all(r.verdict in ("allow", "block") for r in got)
    assert url_templates.judge(df.where("false"), URL_RULES).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    rows = [f"http://shop.com/item/{i}" for i in range(200)] + [f"http://shop.com/ads/{i}/x" for i in range(60)]
    rows += [f"http://shop.com/promo/{i}/x" for i in range(60)] + [f"http://shop.com/new/{i}/x" for i in range(3)] + ["http://shop.com/" + "/".join("abcdefghijkl")]
    rules = [("allow", "shop.com/item/1"), ("block", "shop.com/ads/1"), ("block", "shop.com/promo/1"), ("block", "shop.com/ads/2"), ("block", "shop.com/promo/2")]
    judged = url_templates.judge(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), rules)
    got = judged.collect()
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": list(range(len(rows))), "url": rows}))
    want = con.sql(op1_sql(rules)).fetchall()
    assert sorted(want) == sorted((r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in got)
    of = {r.path: r for r in got}
    assert of["/item/77"].template == "/item/*" and of["/ads/7/x"].template == "/ads/*/x"
    assert of["/item/77"].verdict == "allow" and of["/ads/7/x"].verdict == "block" and of["/promo/7/x"].verdict == "block"
    assert of["/ads/7/x"].blocked_share == of["/promo/7/x"].blocked_share > of["/item/77"].blocked_share
    assert of["/a/b/c/d/e/f/g/h/i/j/k/l"].template == "/*" * 9  # eight segments and the rest


# --- Page text -------------------------------------------------------------

def lcs_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=16), st.lists(st.integers(0, 5), max_size=16))
def test_common_lines_are_a_longest_common_subsequence(a, b):
    got = page_text.common_lines(np.array(a, np.int64), np.array(b, np.int64))
    assert len(got) == lcs_length(a, b)
    assert all(a[i] == b[j] for i, j in got) and all(p < q and s < t for (p, s), (q, t) in zip(got, got[1:], strict=False))


def test_common_lines_of_large_tables():
    rng = random.Random(7)
    a = [rng.randrange(400) for _ in range(9000)]
    b = [x for x in a if rng.random() < 0.9] + [rng.randrange(400) for _ in range(600)]
    got = page_text.common_lines(np.array(a, np.int64), np.array(b, np.int64))
    assert len(got) >= len(b) - 600 and all(a[i] == b[j] for i, j in got)


PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>menu</ul></nav><div class='ad'>buy</div><article><h1>H</h1><p>A &amp; b&eacute;<br>c"
     "<p>x <b>y</b>z<script>var t='</p>';</script><form>f</form><div class=\"comments\">c</div></article><aside>s</aside><footer>f</footer></body>", "H\nA & bé c\nx yz"),
    ("<main><header>site</header><p>one<p>two</main><p>three", "one\ntwo"),
    ("<article><p>cut in the mid", "cut in the mid"), ("<article><p>text<p cla", "text"), ("<p>a <!-- <p>x</p> --> b", "a b"),
    (None, ""), ("", ""), ("   ", ""), ("plain & simple <3", "plain & simple <3"), ("<script>x", ""), ("<article></article>", ""),
    ("<p title='a>b'>q</p>", "q"), ("<article><p>&#65;&nbsp;&lt;b&gt;\t\n x</article>", "A <b> x"), ("<div hidden>h</div>v", "v"),
]


def test_pages_one_by_one(spark):
    df = spark.createDataFrame([(i, f"http://h{i}.net/x", p, "clash") for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in page_text.main_text(df).collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES)}
    assert page_text.main_text(df.where("false")).count() == 0


def test_neighbours_lose_shared_lines_but_not_article_ones(spark):
    def plain(n):
        return f"<div>Site name</div><p>own text {n}</p><p>another {n * n}</p><div>All rights reserved</div>"

    def marked(n):
        return f"<div>Site name</div><article><p>quoted passage</p><p>text {n}</p></article><div>imprint</div>"

    rows = [(n, f"http://plain.org/a/{n}", plain(n)) for n in range(20)] + [(100 + n, f"http://marked.org/{n}", marked(n)) for n in range(5)]
    rows += [(200, None, plain(3)), (201, "http://alone.org/", plain(4)), (300, "http://twice.org/a", plain(5)), (300, "http://twice.org/a", plain(5))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = page_text.main_text(df).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(rows)
    assert all(got[n] == f"own text {n}\nanother {n * n}" for n in range(20))
    assert all(got[100 + n] == f"quoted passage\ntext {n}" for n in range(5))
    assert got[201].startswith("Site name") and got[300].startswith("Site name")


@pytest.mark.parametrize("page, want", [
    ("<main><p>the long main text</p><p>goes on here</p><article>card</article></main>", "the long main text\ngoes on here\ncard"),
    ("<div><p>the long plain text</p></div><article>card</article><nav>menu</nav>", "the long plain text\ncard"),
    ("<main><p>by A</p><article>a long article's text</article></main><p>rest</p>", "a long article's text"),
    ("<div style='overflow:hidden' aria-hidden=\"false\"><article><p>kept</p></article></div>", "kept"),
    ("<div aria-hidden=false data-x='nav hidden'>kept</div><div class=x HIDDEN>gone</div><div hidden=''>gone</div><div hidden='until-found'>found</div>", "kept\nfound"),
])
def test_main_text_is_where_most_text_is(spark, page, want):
    df = spark.createDataFrame([(1, "http://h.net/x", page)], "page_id long, url string, html string")
    assert [r.text for r in page_text.main_text(df).collect()] == [want]


def test_lines_shared_with_neighbours_dont_outweigh_an_article(spark):
    rows = [(n, f"http://h.net/{n}", f"<div>a long unmarked menu that all pages of the host have</div><article>text {n}</article>") for n in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in page_text.main_text(df).collect()} == {n: f"text {n}" for n in range(4)}


# --- Vectors ---------------------------------------------------------------

def links_brute(rows, threshold):
    def ok(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    n = [0] * len(rows)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if a is None or a != b or not ok(v) or not ok(w) or len(v) != len(w):
                continue
            v1, w1 = np.array(v, float), np.array(w, float)
            if v1 @ w1 / (np.sqrt(v1 @ v1) * np.sqrt(w1 @ w1)) >= threshold:
                n[i] += 1
                n[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted((r[0], n[i], least[root(i)], r[0] == least[root(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("tile", [1024, 7])
def test_vectors_match_brute_force(spark, tile):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    rows = []
    for i in range(260):
        v = centres[rng.integers(6)] + rng.normal(size=24) * rng.choice([0.02, 0.25, 2.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3)) if i % 17 else None))
    rows += [(300 + i, rows[5][1], rows[5][2]) for i in range(30)]  # copies
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 24, 1), (403, [float("nan")] + [1.0] * 23, 1), (404, [float("inf")] + [1.0] * 23, 1),
             (405, [None] + [1.0] * 23, 1), (406, [1.0, 0.0], 1), (407, [1.0, 0.01], 1), (408, [1e-30, 0.0], 1), (409, [-1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, cid int")
    got = sorted(tuple(r) for r in vector_links.near_vectors(df, 0.93, tile=tile).collect())
    assert got == links_brute(rows, 0.93)
    assert vector_links.near_vectors(df.where("false")).count() == 0


# --- Tokenizers ------------------------------------------------------------

@pytest.fixture(scope="module")
def reference_bpe():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_matches_the_library(spark, reference_bpe):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate([*ODD_TEXTS, *ADDED, None])], "doc_id long, text string")
    rows = docs.unionByName(odd)
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in byte_bpe.round_trip(rows, RANKS, public_tokenizers.PATTERN).collect():
        ids = reference_bpe.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    encoded = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    back = {r.doc_id: r.text for r in byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {i: texts[i] for i in back}


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60))
def test_backtracking_equals_the_merges(data):
    bpe = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    whole = bpe.ranks.get(data)
    assert bpe.encode_bytes(data) == ([whole] if whole is not None else byte_bpe.merge(bpe.ranks, data))


def test_byte_bpe_odd_rows(odd_docs, no_docs):
    got = byte_bpe.round_trip(odd_docs, RANKS, public_tokenizers.PATTERN)
    assert got.count() == odd_docs.count() and {r.n_tokens for r in got.where("doc_id in (3, 4)").collect()} == {0}
    assert byte_bpe.round_trip(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=400))
def test_elias_fano_selects(gaps):
    values = np.cumsum(np.array(gaps, np.int64))
    ef = token_files.EliasFano.build(values)
    assert ef.all().tolist() == values.tolist() == [ef.select(i) for i in range(len(values))]
    if len(values):
        bits = 8 * (len(ef.low) + len(ef.high)) / len(values)
        assert bits <= 2 + np.log2(max(values[-1], 1) / len(values) + 1) + 1 + 72 / len(values)


#: The library finds its added tokens anywhere in a text, in their own case only.
ADDED = ["a <|endoftext|> b", "x<|startoftext|>y<|endoftext|>", "<|ENDOFTEXT|> <|endof text|>", "<|endoftext|>" * 3, "\n<|startoftext|>.\tÉté <|"]


def test_token_files_match_the_library(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate([*ODD_TEXTS, *ADDED, None])], "doc_id long, text string")
    rows = docs.unionByName(odd).repartition(5)
    path = str(tmp_path / "files")
    token_files.write_token_files(rows, path, WORDS, end_id=1, shard_ids=3000)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, path).collect()}
    tok = Tokenizer.from_file(WORDS)
    start = 0
    for r in sorted(rows.collect(), key=lambda r: r.doc_id):
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        assert got[r.doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    shards = spark.read.parquet(path).collect()
    assert len(shards) > 5
    ef, ids = token_files.open_shard(bytes(shards[0].payload))
    assert ids.dtype == np.dtype("<u2") and len(ids) == shards[0].n_ids and ef.select(ef.n - 1) == len(ids)


def test_token_files_odd_rows(spark, odd_docs, no_docs, tmp_path):
    token_files.write_token_files(odd_docs, str(tmp_path / "a"), WORDS, end_id=1)
    got = token_files.read_token_files(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert len(got) == odd_docs.count() and [r.doc_id for r in got[:2]] == [None, None]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    token_files.write_token_files(no_docs, str(tmp_path / "b"), WORDS, end_id=1)
    assert token_files.read_token_files(spark, str(tmp_path / "b")).count() == 0


# --- The registered queries ------------------------------------------------

def test_the_word_tokenizer_drops_white_space_as_the_word_store_needs():
    encoder = token_files.WordEncoder(WORDS, 2)
    for text in ODD_TEXTS:
        ids = encoder.tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text.encode()), "<u2").tolist() == ids


def test_all_queries_return_whole_tables(spark):
    from dockflow.llm.queries import queries

    docs, pages, vectors = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count() for t in ("documents", "pages", "embeddings"))
    want = {"op1": pages, "op2": docs, "op3": docs, "op4": pages, "op5": vectors, "op6": docs, "op8": docs, "op9": docs, "op10": docs}
    for name, query in queries().items():
        if (op := name.split("_")[0]) in want:
            assert query(spark, SF_SMALL).count() == want[op], name


def test_pipeline_matches_brute_force(spark, reference_bpe):
    """run() against the stages' own rules, applied to collected rows one after another."""
    import corpus_pipeline
    from dockflow.llm import decontaminate, secret_scan, simhash, toxicity

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    model = toxicity.fit_model(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    pair = model.compressors() if model.weights else None
    rows = {i: t for i, t in rows.items() if model.probability([model.features(t.encode(), pair) if pair else []])[0] < 0.3}
    fps = {i: simhash.fingerprint(t.encode()) for i, t in rows.items()}
    root = {}
    for i in sorted(fps):
        if i in root:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            root[x] = i
            todo += [y for y in fps if y not in root and y not in todo and (fps[x] ^ fps[y]).bit_count() <= 3]
    rows = {i: t for i, t in rows.items() if root[i] == i}
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    joined = {i: b" " + b" ".join(decontaminate.words_of(t)) + b" " for i, t in rows.items()}
    exact = {i for i, t in joined.items() if any(b" " + b" ".join(w) + b" " in t for w in items if w)}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert not exact & set(got) and set(got) <= set(rows)
    assert len(set(rows) - exact - set(got)) <= 3  # edited copies of items
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs.where(F.col("doc_id").isin(list(got)))).collect()}
    same = [i for i in got if clean[i] == rows[i]]
    assert len(same) > 0.9 * len(got)
    assert all(got[i] == reference_bpe.encode_ordinary(rows[i]) for i in same)


def test_pipeline_stages_on_odd_rows(spark, odd_docs, tmp_path):
    import corpus_pipeline

    docs = odd_docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    base = str(tmp_path)
    spark.createDataFrame([(1, "an item that no document holds at all")], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    for start in (docs, docs.where("false")):
        rows = start
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, base)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert rows.columns == corpus_pipeline.COLUMNS, name
        assert (rows.count() > 0) == (start is docs)


def test_a_hot_id_is_spread_and_stays_in_order(spark, tmp_path):
    rows = [(7 if i % 3 else i, f"text {i}") for i in range(600)] + [(None, "n")] * 50
    path = str(tmp_path / "hot")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, WORDS, end_id=1)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda x: (x is not None, x or 0))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    assert spark.read.parquet(path).where(F.array_contains("doc_ids", 7)).count() > 4
