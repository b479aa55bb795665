"""Templates and merged branches of the URL filter against a plain model and against SQL."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from dockflow.llm import url_templates as ut
from dockflow.llm.queries import op1_sql


def model(urls, says):
    """Template and blocked share of each (host, path), by the rules of the module's text."""
    segs = []
    for host, path in urls:
        s = [x for x in path.split("/") if x]
        segs.append((host, s[:ut.DEPTH] + (["/".join(s[ut.DEPTH:])] if len(s) > ut.DEPTH else [])))
    t = [() for _ in segs]
    for d in range(max(len(s) for _, s in segs)):
        n, total = Counter(), Counter()
        for (h, s), x in zip(segs, t):
            if len(s) > d:
                n[h, x, s[d]] += 1
                total[h, x] += 1
        t = [x if len(s) <= d else (*x, s[d] if n[h, x, s[d]] >= max(ut.SUPPORT, total[h, x] ** 0.5) else "*") for (h, s), x in zip(segs, t)]
    labels = defaultdict(lambda: [0, 0])
    for (h, _), x, v in zip(segs, t, says):
        labels[h, x][0] += v is not None
        labels[h, x][1] += v == "block"
    prior = sum(b for _, b in labels.values()) / max(1, sum(n for n, _ in labels.values()))
    unit = {k: k for k in labels}
    for d in reversed(range(max(len(x) for _, x in labels))):
        sums = defaultdict(lambda: [0, 0])
        for k, u in unit.items():
            sums[u][0] += labels[k][0]
            sums[u][1] += labels[k][1]
        nodes = defaultdict(list)
        for (h, x), (n, b) in sums.items():
            if len(x) > d and x[d] != "*" and not x[d].startswith("?") and n >= ut.LABELS:
                nodes[h, x[:d], x[d + 1:]].append(((h, x), n, b))

        def alike(own, mark):
            tn, tb = sum(n for _, n, _ in own), sum(b for *_, b in own)
            p = tb / max(tn, 1)
            some = [u for u, n, b in own if tn > n and abs(b / n - (tb - b) / (tn - n)) <= ut.ALIKE * (p * (1 - p) * (1 / n + 1 / (tn - n))) ** 0.5]
            return {u: (u[0], (*u[1][:d], mark, *u[1][d + 1:])) for u in some} if len(some) > 1 else {}

        to = {}
        for own in nodes.values():
            p = sum(b for *_, b in own) / sum(n for _, n, _ in own)
            to |= alike(own, "?")
            rest = [x for x in own if x[0] not in to]
            to |= alike([x for x in rest if x[2] / x[1] >= p], "?+") | alike([x for x in rest if x[2] / x[1] < p], "?-")
        unit = {k: to.get(u, u) for k, u in unit.items()}
    pool = defaultdict(lambda: [0, 0])
    for k, u in unit.items():
        pool[u][0] += labels[k][0]
        pool[u][1] += labels[k][1]
    share = {k: (pool[u][1] + ut.SMOOTHING * prior) / (pool[u][0] + ut.SMOOTHING) for k, u in unit.items()}
    return [("/" + "/".join(x), share[h, x]) for (h, _), x in zip(segs, t)]


def judged(spark, urls, rules):
    df = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate(urls)], "page_id long, url string").repartition(3)
    return sorted(ut.judge(df, rules).collect(), key=lambda r: r.page_id)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_model_and_sql(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", "news", "ads", "shop"]
    urls = []
    for _ in range(700):
        host = rng.choice(["big.com", "big.com", "big.com", "small.org"])
        depth = rng.choice([0, 1, 2, 3, 3, 4, 11])
        path = "".join("/" + (rng.choice(names[:2 + k % 5]) if rng.random() < 0.75 else str(rng.randrange(50))) for k in range(depth))
        urls.append((host, path + rng.choice(["", "/", f"/{rng.randrange(9)}"])))
    rules = [(rng.choice(["allow", "block"]), f"{h}/{x}/{y}") for h in ("big.com", "small.org") for x in names[:3] for y in names[:3]]
    got = judged(spark, urls, rules)
    says = [dict((r, v) for v, r in rules).get(r.rule) for r in got]
    assert len({v for v in says}) == 3
    for r, (template, share) in zip(got, model(urls, says), strict=True):
        assert r.template == template and r.blocked_share == pytest.approx(share, abs=1e-12)
        assert r.verdict == (dict((x, v) for v, x in rules)[r.rule] if r.rule else "block" if share >= ut.REJECT_AT else "allow")
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": list(range(len(urls))), "url": [f"http://{h}{p}" for h, p in urls]}))
    assert sorted(con.sql(op1_sql(rules)).fetchall()) == [(r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in got]


@pytest.mark.parametrize("names", list(itertools.permutations(["zz", "aa", "mm"])))
def test_small_branches_flip_no_pure_one(spark, names):
    """A branch with 100 blocked of 100, beside one with an allowed page and one with a blocked page."""
    pure, good, bad = names
    urls = [("h.com", f"/{pure}/{i}/x") for i in range(150)] + [("h.com", f"/{n}/{i}/x") for n in (good, bad) for i in range(30)]
    urls += [("other.org", f"/x/{i}") for i in range(150)]
    rules = [("allow", "other.org/x/")] + [("block", f"h.com/{pure}/{k}") for k in range(2, 10)] + [("allow", f"h.com/{good}/1/"), ("block", f"h.com/{bad}/1/")]
    got = judged(spark, urls, rules)
    assert all(r.verdict == "block" for r in got if r.path.startswith(f"/{pure}/"))
    assert all(r.verdict == "allow" for r in got if r.path.startswith((f"/{good}/", f"/{bad}/")) and r.rule is None)


def test_branches_merge_under_every_node(spark):
    urls = [("h.com", f"/s/{n}/{i}") for n in "abq" for i in range(40)] + [("h.com", f"/r/{n}/{i}") for n in "ab" for i in range(40)]
    rules = [("block", f"h.com/s/{n}/1") for n in "ab"] + [("block", "h.com/r/a/1"), ("block", "h.com/r/b/1"), ("allow", "h.com/s/q/")]
    got = {r.path: r for r in judged(spark, urls, rules)}
    assert got["/s/a/33"].template == "/s/a/*"
    assert got["/s/a/33"].blocked_share == got["/s/b/33"].blocked_share
    assert got["/r/a/33"].blocked_share == got["/r/b/33"].blocked_share
    assert got["/s/q/33"].blocked_share < 0.5 < ut.REJECT_AT < got["/s/a/33"].blocked_share


def test_templates_without_labels_have_the_corpus_share(spark):
    urls = [("h.com", f"/{n}/{i}") for n in ("de", "es", "fr") for i in range(40)] + [("other.org", f"/x/{i}") for i in range(200)]
    got = judged(spark, urls, [("block", "h.com/de/"), ("allow", "other.org/x/")])
    of = {r.path: r for r in got}
    assert of["/es/7"].blocked_share == of["/fr/7"].blocked_share == pytest.approx(40 / 240) and of["/es/7"].verdict == "allow"


def test_a_small_section_of_a_large_host_is_judged_by_itself(spark):
    urls = [("h.com", f"/main/{i}") for i in range(2000)] + [("h.com", f"/bad/{i}") for i in range(60)]  # 3 %
    got = {r.path: r for r in judged(spark, urls, [("allow", "h.com/main/1"), ("block", "h.com/bad/1"), ("block", "h.com/bad/2")])}
    assert got["/bad/55"].template == "/bad/*" and got["/bad/55"].verdict == "block" and got["/main/999"].verdict == "allow"
