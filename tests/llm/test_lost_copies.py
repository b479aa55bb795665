"""Edited copies with inserted blocks, and columns whose names stages use inside."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from dockflow.llm import decontaminate

from .test_text_ops import smith_waterman


def _copy(rng, words):
    """A copy with words changed, dropped and added, and up to two foreign blocks of up to one and a half times its length."""
    rate = rng.choice([0, 0.02, 0.05, 0.1, 0.2])
    out = []
    for w in words:
        r = rng.random()
        if r < rate / 3:
            continue
        out.append(f"x{rng.randrange(10**6)}" if r < rate else w)
        if rng.random() < rate / 3:
            out.append(f"y{rng.randrange(10**6)}")
    for _ in range(rng.choice([0, 0, 1, 1, 2])):
        at = rng.randrange(len(out) + 1)
        out[at:at] = [f"z{rng.randrange(10**6)}" for _ in range(rng.randrange(int(1.5 * len(words)) + 1))]
    return out


def _intact(item, copy):
    grams = {tuple(item[k:k + 3]) for k in range(len(item) - 2)}
    return any(tuple(copy[k:k + 3]) in grams for k in range(len(copy) - 2))


def test_hits_and_scores_equal_whole_alignments():
    """Wherever one trigram is intact the passages hold the best alignment with all its score."""
    rng = random.Random(3)
    found = lost = without = 0
    for _ in range(250):
        m = rng.choice([10, 15, 25, 40, 80, 120, 200])
        item = [f"i{rng.randrange(3 * m)}" for _ in range(m)]
        copy = _copy(rng, item)
        doc = [f"a{rng.randrange(50)}" for _ in range(rng.randrange(30))] + copy + [f"b{rng.randrange(50)}" for _ in range(rng.randrange(30))]
        items = decontaminate.Items.build([(1, " ".join(item)), (2, " ".join(f"o{k}" for k in range(20)))])
        items.choose_seeds({k: np.full(len(g), rng.choice([1, 10**6])) for k, g in items.grams.items()}, 10**6)
        ids = items.doc_ids(" ".join(doc))
        whole = smith_waterman(items.tokens[0].astype(int).tolist(), ids.astype(int).tolist())
        jobs = [(0, i, ids[a:b]) for i, a, b in items.passages(ids) if i == 0]
        best = max((s for s, _, _ in decontaminate._align_all(items, jobs)), default=0)
        assert best <= whole
        if whole >= m and _intact(item, doc):  # half of the perfect 2 m
            assert best == whole, (m, whole, best)
            found += 1
        elif whole >= m:
            without += best < m
            lost += 1
    assert found > 150 and lost < 20


def test_the_two_halves_of_a_copy_far_apart(spark):
    item = [f"i{k}" for k in range(100)]
    for gap, edits in ((60, (20, 70)), (80, ()), (98, ())):
        copy = [f"x{k}" if k in edits else w for k, w in enumerate(item)]
        text = " ".join([*copy[:50], *[f"z{k}" for k in range(gap)], *copy[50:]])
        (hit,) = decontaminate.contaminated(
            spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
        assert hit.score == (2 * (100 - len(edits)) - len(edits) - gap) / 200 and (hit.first_word, hit.end_word) == (0, 100 + gap)


def test_stages_leave_columns_of_any_name(spark, tmp_path):
    import corpus_pipeline

    names = ["row__", "ROW_ID__", "text_before", "hits__0", "benchmark_hits", "benchmark_hits__0", "toxicity_score", "found", "fp", "ids"]
    rows = [(i, f"document {i} says password=abcdef{i}123 and more words of its own number {i * i}", "en", "s", 5, *(f"{n}{i}" for n in names)) for i in range(20)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, kind)
    spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing that any document holds at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.select("doc_id", *(F.col(f"`{n}`") for n in names)).collect()
        assert got or name == "toxicity"
        assert all(tuple(r) == (r.doc_id, *(f"{n}{r.doc_id}" for n in names)) for r in got), name
    masked = corpus_pipeline.secrets(spark, docs, str(tmp_path)).collect()
    assert len(masked) == 20 and all("[SECRET]" in r.text and r.n_chars == len(r.text) for r in masked)


def test_keys_of_every_alphabet_are_found(spark):
    """Nine of ten planted keys of each alphabet with digits or both cases, from 20 characters on, among words and slugs."""
    from dockflow.llm import secret_scan

    rng = random.Random(9)
    lower, upper, digits = secret_scan.LOWER, secret_scan.UPPER, secret_scan.DIGITS
    alphabets = {"digits": digits, "hex": digits + "abcdef", "base32": upper + "234567", "lower": digits + lower, "letters": upper + lower, "base62": digits + upper + lower, "base64": digits + upper + lower + "+/"}
    words = ["".join(rng.choice(["an", "er", "th", "re", "ion", "st"]) for _ in range(rng.randrange(8, 16))) for _ in range(1500)]
    slugs = ["-".join(rng.choice(["the", "release", "of", "note", "2024"]) for _ in range(rng.randrange(4, 9))) for _ in range(300)]
    camel = ["".join(rng.choice(["get", "Value", "Of", "Item", "List"]) for _ in range(7)) for _ in range(100)]
    planted = {f"{name}{n}": ["".join(rng.choice(a) for _ in range(n)) for _ in range(20)] for name, a in alphabets.items() for n in (20, 24, 32, 40)}
    keys = [k for own in planted.values() for k in own]
    tokens = [*words, *slugs, *camel, *keys]
    rng.shuffle(tokens)
    rows = [(i, " ".join(tokens[10 * i:10 * i + 10])) for i in range(len(tokens) // 10)]
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    found = {texts[r.doc_id][s.s:s.e] for r in got for s in r.random}
    recall = {name: sum(k in found for k in own) / len(own) for name, own in planted.items()}
    assert sum(recall.values()) / len(recall) >= 0.9 and min(recall.values()) >= 0.7, recall
    assert len(found - set(keys)) <= 0.05 * len(found), found - set(keys)
