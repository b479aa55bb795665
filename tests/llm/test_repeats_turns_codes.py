"""Repeated word windows, conversation repair and vector codes against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from functools import cache

import numpy as np
import pytest

from dockflow.llm import conversation_repair, phrase_automata, queries, vector_codes
from dockflow.llm.phrase_automata import WINDOW, Shard, entry_text, remove_passages


# Repeated word windows

def kept_by_brute_force(rows):
    """(doc_id, n_words, spans, kept) of each row."""
    last = float("inf")
    words = [(last if d is None else d, d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for key, _, own in words:
        for s in range(len(own) - WINDOW + 1):
            w = tuple(own[s:s + WINDOW])
            least[w] = min(least.get(w, key), key)
    out = []
    for key, doc, own in words:
        gone = set()
        for s in range(len(own) - WINDOW + 1):
            if least[tuple(own[s:s + WINDOW])] < key:
                gone.update(range(s, s + WINDOW))
        spans = []
        for i in sorted(gone):
            if spans and spans[-1][1] == i:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((i, i + 1))
        out.append((doc, len(own), spans, b" ".join(w for i, w in enumerate(own) if i not in gone)))
    return sorted(out, key=repr)


def kept_by_operator(df, **options):
    return sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans], bytes(r.kept)) for r in remove_passages(df, **options).collect()), key=repr)


def passages(seed, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of and quick brown été stone 😀 river".split()) + str(rng.randrange(40))
    shared = [[word() for _ in range(rng.choice([49, 50, 51, 70, 200]))] for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += [word() for _ in range(rng.randrange(30))]
            if rng.random() < 0.7:
                p = rng.choice(shared)
                a = rng.randrange(0, max(1, len(p) - 55))
                parts += p[a:a + rng.randrange(45, 90)]
        rows.append((i if rng.random() < 0.9 else rng.choice([None, 3]), rng.choice([" ", "\n", "\t\x0b "]).join(parts)))
    return rows


def odd_repeats():
    line = " ".join(f"w{i}" for i in range(60))
    same = " ".join(["a"] * 150)
    long = "x" * 3000
    huge = " ".join([long if i % 20 == 0 else f"v{i}" for i in range(90)])
    return [
        (5, line), (5, line), (2, line.upper()), (7, line + " tail"), (9, "head " + line), (1, None), (4, ""), (6, " \n\t "), (8, same), (10, same + " b"), (11, "a " * 50),
        (None, line), (None, line), (12, huge), (13, "before " + huge), (14, huge.replace("x", "y", 1)), (15, "w " * 49), (16, line.replace(" ", " ")), (17, line.replace(" ", " ")),
        (18, " ".join(["a", "b"] * 80)), (19, " ".join(["b", "a"] * 60)),
    ]


@pytest.mark.parametrize("most", [1024, 1])
def test_repeated_windows_equal_brute_force(spark, most):
    for rows in (passages(1), passages(2), odd_repeats()):
        df = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, chunk int, told string").repartition(5)
        assert kept_by_operator(df, most_entries=most) == kept_by_brute_force(rows)


def test_windows_by_themselves_where_many_entries_share_an_anchor(spark):
    rng = random.Random(5)
    line = " ".join(f"licence{i}" for i in range(30))
    tail = " ".join(f"tail{i}" for i in range(30))
    rows = [(i, " ".join(f"r{rng.randrange(10**6)}" for _ in range(40)) + " " + line + " " + (tail if i % 3 == 0 else " ".join(f"s{rng.randrange(10**6)}" for _ in range(40)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    want = kept_by_brute_force(rows)
    assert sum(bool(r[2]) for r in want) == 99
    assert kept_by_operator(df) == want
    assert kept_by_operator(df, most_entries=8) == want


def test_no_documents_and_odd_documents(spark, odd_docs, no_docs):
    assert kept_by_operator(no_docs) == []
    assert kept_by_operator(odd_docs) == kept_by_brute_force([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_entries_come_whole_across_pieces_and_blocks(monkeypatch):
    monkeypatch.setattr(phrase_automata, "PIECE", 97)
    monkeypatch.setattr(phrase_automata, "BLOCK_BITS", 8)
    texts = [t.encode() for _, t in passages(3)] + [b"", b"a b"]
    seen = {}
    for e in phrase_automata.entries_of(texts):
        for d, a, n, p in zip(e.doc.tolist(), e.at.tolist(), e.count.tolist(), e.place.tolist(), strict=True):
            assert e.words[a:a + n + WINDOW - 1] == texts[d].split()[p:p + n + WINDOW - 1]
            for k in range(n):
                seen[d, p + k] = seen.get((d, p + k), 0) + 1
    want = {(d, s) for d, t in enumerate(texts) for s in range(len(t.split()) - WINDOW + 1)}
    assert set(seen) == want
    assert all(seen[k] == 1 for k in want)


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_shards_need_no_good_hash(monkeypatch, bits):
    real = phrase_automata.windows_hash
    monkeypatch.setattr(phrase_automata, "windows_hash", lambda h: tuple(x & np.uint64((1 << bits) - 1) for x in real(h)))
    rng = random.Random(bits)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(25):
        a = rng.randrange(60)
        t = base[a:a + rng.randrange(50, 70)]
        if rng.random() < 0.4:
            t = t[:rng.randrange(50)] + ["other"] + t
        texts.append(" ".join(t).encode())
    texts = list(dict.fromkeys(texts)) + [b" ".join([b"z"] * 70)]
    low = np.array([rng.randrange(100) for _ in texts])
    high = low + np.array([rng.randrange(3) for _ in texts])
    least = {}
    for t, x in zip(texts, low.tolist(), strict=True):
        w = t.split()
        for s in range(len(w) - WINDOW + 1):
            least[tuple(w[s:s + WINDOW])] = min(x, least.get(tuple(w[s:s + WINDOW]), x))
    want = [least[tuple(w[s:s + WINDOW])] for w in (t.split() for t in texts) for s in range(len(w) - WINDOW + 1)]
    assert Shard(texts, low, high).confirmed().tolist() == want


def test_long_words_stand_as_digests():
    assert entry_text([b"a", b"b" * 64]) == b"a " + b"b" * 64
    digest = hashlib.sha256(b"b" * 65).hexdigest().encode()
    assert entry_text([b"a", b"b" * 65]) == b"a \xff" + digest


# Conversations

def best_edits(turns):
    """(cost, audit, lines) by trying all edits: turns are (role, text, must go, truncated)."""

    @cache
    def best(i, last, inserts=0):  # three inserts side by side are never needed
        found = [(0, "", ())] if i == len(turns) and last in ("", "a") else []
        write = "a" if last == "u" else "u"
        full = {"u": "user", "a": "assistant"}[write]

        def after(cost, edit, lines, *state):
            c, a, rest = best(*state)
            found.append((cost + c, edit + a, lines + rest))

        if i < len(turns):
            role, text, must_go, truncated = turns[i]
            after(3, "D", (), i + 1, last)
            if not must_go:
                if role[:1] == write or (role[:1] == "s" and last == ""):
                    after(truncated, "K", (f"{role}:{text}",), i + 1, role[:1])
                after(2 + truncated, "R", (f"{full}:{text}",), i + 1, write)
        if inserts < 3:
            after(2, "I", (full + ":",), i, write, inserts + 1)
        return min(found, default=(10**9, "", ()))

    return best(0, "")


def repaired_by_brute_force(rows):
    """The query's rows from damaged (conv_id, turn, role, text) rows."""
    out = []
    space = " \t\n\x0b\x0c\r"
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, turns, n = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            body = text.rstrip(space)
            blank, twice = not body, bool(body) and (role, text) in seen
            seen.add((role, text))
            cut = not blank and not twice and body[-1] not in ".!?"
            n = [a + b for a, b in zip(n, (blank, twice, cut))]
            turns.append((role, text, blank or twice, int(cut)))
        numbers = {r[1] for r in own if r[1] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, lines = best_edits(tuple(turns))
        out.append((conv, gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def repaired_by_operator(df):
    done = conversation_repair.repair(df)
    summary = {r.conv_id: r for r in done.summary().collect()}
    digests = {r.conv_id: r for r in done.digests().collect()}
    assert set(summary) == set(digests)
    turns = {}
    for r in done.turns().collect():
        turns.setdefault(r.conv_id, []).append((r.block, r.place, r.edit, r.role, r.text))
    for conv, found in turns.items():
        found.sort(key=lambda x: x[:2])
        assert "".join(x[2] for x in found) == digests[conv].audit
        text = "\n".join(f"{role}:{text}" for _, _, edit, role, text in found if edit != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == digests[conv].repaired_sha256
    return sorted(((*summary[c][:7], digests[c].audit, digests[c].repaired_sha256) for c in summary), key=repr)


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "u", " "])
            text = rng.choice(["Yes.", "No", "What?", "Ok!\n", " ", "", "Ü. ", "x ", "One two", "Yes."])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, turn + 3]), role, text))
    return rows


@pytest.mark.parametrize("bits", [10, 1])
def test_repair_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(conversation_repair, "BLOCK_BITS", bits)
    rows = conversations(bits, 40, 12)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, r int").repartition(3)
    assert repaired_by_operator(df) == repaired_by_brute_force(rows)


def test_repair_of_a_conversation_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK_BITS", 3)
    rng = random.Random(8)
    rows = [("hot", t, rng.choice(["user", "assistant", "system"]), f"{t // 2}{rng.choice(['.', '', '?'])}") for t in range(150)] + [("cold", 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(4)
    assert repaired_by_operator(df) == repaired_by_brute_force(rows)


def test_repair_nulls_and_nothing(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert repaired_by_operator(spark.createDataFrame([], kind)) == []
    found = repaired_by_operator(spark.createDataFrame([(1, None, None, None), (1, None, "user", "Hi."), (1, 5, "assistant", "Ho.")], kind))
    lines = "user:Hi.\nassistant:Ho."
    assert found == [(1, 0, 1, 0, 0, 1, 3, "DKK", hashlib.sha256(lines.encode()).hexdigest())]


def test_query_damage(spark):
    rows = [(c, t, "user", f"a{c}. b!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    got = sorted(map(tuple, queries.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, {1: "", 2: text.replace(".", "").replace("!", "")}.get(kind, text))
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(want, key=repr)


def test_ranks_order_audits():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 16, (30, 9)).astype(np.uint8)
    codes[4, 5:] = conversation_repair.PAD
    _, target, label = conversation_repair.optimal_arcs(codes, np.tile(conversation_repair.END, (30, 1)))
    rank, jumps = conversation_repair.rank_paths(target, label, 28)
    nodes = np.arange(30)[:, None] * 40 + np.arange(4)
    audits = conversation_repair.audits_of(nodes.ravel(), jumps, label)
    order = rank[nodes.ravel()]
    for a, b in itertools.combinations(range(len(audits)), 2):
        assert (audits[a] < audits[b]) == (order[a] < order[b])


# Vector codes

def test_orchard_equals_brute_force():
    rng = np.random.default_rng(1)
    for k, d, spread in ((1, 3, 5), (16, 8, 3), (16, 2, 2), (40, 4, 1000), (5, 0, 1)):
        book = rng.integers(-spread, spread + 1, (k, d))
        book[k // 2] = book[0]  # equal entries
        points = rng.integers(-spread, spread + 1, (500, d))
        far = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
        best, near = vector_codes.orchard(points, book)
        assert (best == far.argmin(axis=1)).all()
        assert (near == far.min(axis=1)).all()
        again, _ = vector_codes.orchard(points, book, start=rng.integers(0, k, 500))
        assert (again == far.argmin(axis=1)).all()


def codes_by_brute_force(rows, parts=8, entries=16, rounds=6):
    kept = [(v, lab, [int(np.floor(4096 * float(x))) for x in vec]) for v, vec, lab in rows if vec is not None and all(x is not None and np.isfinite(x) for x in vec)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    edges = vector_codes.edges_of(len(kept[0][2]), parts)
    cut = [[r[2][a:b] for a, b in zip(edges, edges[1:])] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    nearest = lambda p, x: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(rounds):
        groups = [[[] for _ in books[p]] for p in range(parts)]
        for c in cut:
            for p in range(parts):
                groups[p][nearest(p, c[p])].append(c[p])
        books = [[[sum(x) // len(g) for x in zip(*g)] if g else books[p][e] for e, g in enumerate(groups[p])] for p in range(parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (v, lab, _), c in zip(kept, cut):
        code = [nearest(p, c[p]) for p in range(parts)]
        out.append([v, lab, bytes(code), sum(far(c[p], books[p][code[p]]) for p in range(parts))])
    return sorted(((v, c, e, sum(o[3] for o in out if o[1] == lab), digest) for v, lab, c, e in out), key=repr)


@pytest.mark.parametrize("n,dims", [(300, 16), (9, 16), (40, 11), (0, 8)])
def test_vector_codes_equal_brute_force(spark, n, dims):
    rng = random.Random(n)
    vector = lambda: [rng.choice([-1.0, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(dims)]
    rows = [(i if i % 17 else rng.choice([None, 3]), vector(), rng.choice([None, 1, 2])) for i in range(n)]
    if n:
        rows += [(500, None, 1), (501, [float("nan")] * dims, 1), (502, [None] * dims, 2), (503, [float("inf")] + [0.0] * (dims - 1), 2), (504, [1.0], 1), rows[3], rows[3]]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<float>, label int, codes string, error int").repartition(3)
    rows = [tuple(r)[:3] for r in df.collect()]  # as floats
    got = sorted(((r.vec_id, bytes(r.codes), r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.vector_codes(df).collect()), key=repr)
    assert got == codes_by_brute_force(rows)


def test_labels_of_any_type_and_empty_vectors(spark):
    rows = [(1, [], "a"), (2, [], None)]
    got = vector_codes.vector_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {(r.vec_id, r.label, bytes(r.codes), r.error, r.label_error) for r in got} == {(1, "a", bytes(8), 0, 0), (2, None, bytes(8), 0, 0)}
