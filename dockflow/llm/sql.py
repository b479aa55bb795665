"""DuckDB SQL of the queries on secrets, repeated word windows, conversations and vector codes."""

from __future__ import annotations

from dockflow.llm import secret_scan as s

OP11_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
),
d AS (SELECT doc_id, ws, len(ws) AS n FROM w),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, n - 48)) AS p FROM d WHERE n >= 50)),
least AS (SELECT s, MIN(doc_id) AS first FROM win GROUP BY s),
hit AS (SELECT win.doc_id, win.p FROM win JOIN least USING (s) WHERE least.first < win.doc_id),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, n + 1)) AS p FROM d WHERE n > 0),
near AS (
  SELECT word.doc_id, word.x, word.p, MAX(hit.p) OVER (PARTITION BY word.doc_id ORDER BY word.p) AS h
  FROM word LEFT JOIN hit ON hit.doc_id = word.doc_id AND hit.p = word.p
),
kept AS (
  SELECT doc_id, COUNT(*) FILTER (WHERE h IS NOT NULL AND p < h + 50) AS gone, string_agg(x, ' ' ORDER BY p) FILTER (WHERE h IS NULL OR p >= h + 50) AS k
  FROM near GROUP BY doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_words, CAST(COALESCE(gone, 0) AS BIGINT) AS n_removed, sha256(COALESCE(k, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

OP12_SQL = """
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
    COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS word
  FROM conversations
),
summed AS (
  SELECT *, xor(list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(word, ''), lambda ch: CAST(ord(ch) AS UBIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
      lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END)
  ), CAST(4294967295 AS UBIGINT)) % 20 AS kind FROM raw
),
spoilt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed WHERE kind <> 0
),
placed AS (
  SELECT *, COALESCE(CAST(conv_id AS VARCHAR), 'null') AS c, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM spoilt
),
faulty AS (
  SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
    LEAD(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS next, i = COUNT(*) OVER (PARTITION BY conv_id) AS last
  FROM placed
),
rows AS (
  SELECT *, NOT blank AND NOT duplicate AND right(body, 1) NOT IN ('.', '!', '?') AS truncated, blank OR duplicate AS gone,
    CASE WHEN blank OR duplicate OR role[1] <> 's' THEN 1000000000 ELSE 0 END AS cs,
    CASE WHEN blank OR duplicate THEN 1000000000 WHEN role[1] = 'u' THEN 0 ELSE 2 END AS cu,
    CASE WHEN blank OR duplicate THEN 1000000000 WHEN role[1] = 'a' THEN 0 ELSE 2 END AS ca,
    CASE WHEN role[1] = 'u' THEN 'K' ELSE 'R' END AS lu, CASE WHEN role[1] = 'a' THEN 'K' ELSE 'R' END AS la,
    role || ':' || text AS own, CASE WHEN role[1] = 'u' THEN role ELSE 'user' END || ':' || text AS as_user,
    CASE WHEN role[1] = 'a' THEN role ELSE 'assistant' END || ':' || text AS as_assistant
  FROM faulty
),
way AS (
  SELECT c, i + 1 AS i, {'c': 0::BIGINT, 'a': '', 't': CAST([] AS VARCHAR[])} AS g0, {'c': 4::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']} AS g1,
    {'c': 2::BIGINT, 'a': 'I', 't': ['assistant:']} AS g2, {'c': 0::BIGINT, 'a': '', 't': CAST([] AS VARCHAR[])} AS g3
  FROM rows WHERE last
  UNION ALL
  SELECT c, i,
    list_min([h0, {'c': 2 + f2.c, 'a': 'I' || f2.a, 't': list_prepend('user:', f2.t)}]) AS g0,
    list_min([h1, {'c': 2 + f2.c, 'a': 'I' || f2.a, 't': list_prepend('user:', f2.t)}]) AS g1, f2 AS g2, f3 AS g3
  FROM (
    SELECT *, list_min([h2, {'c': 2 + h3.c, 'a': 'I' || h3.a, 't': list_prepend('assistant:', h3.t)}]) AS f2,
      list_min([h3, {'c': 2 + h2.c, 'a': 'I' || h2.a, 't': list_prepend('user:', h2.t)}]) AS f3
    FROM (
      SELECT c, i, list_min([d0, s, u]) AS h0, list_min([d1, u]) AS h1, list_min([d2, a]) AS h2, list_min([d3, u]) AS h3
      FROM (
        SELECT rows.c AS c, rows.i AS i,
          {'c': 3 + g0.c, 'a': 'D' || g0.a, 't': g0.t} AS d0, {'c': 3 + g1.c, 'a': 'D' || g1.a, 't': g1.t} AS d1,
          {'c': 3 + g2.c, 'a': 'D' || g2.a, 't': g2.t} AS d2, {'c': 3 + g3.c, 'a': 'D' || g3.a, 't': g3.t} AS d3,
          {'c': cs + CAST(truncated AS INTEGER) + g1.c, 'a': 'K' || g1.a, 't': list_prepend(own, g1.t)} AS s,
          {'c': cu + CAST(truncated AS INTEGER) + g2.c, 'a': lu || g2.a, 't': list_prepend(as_user, g2.t)} AS u,
          {'c': ca + CAST(truncated AS INTEGER) + g3.c, 'a': la || g3.a, 't': list_prepend(as_assistant, g3.t)} AS a
        FROM way JOIN rows ON rows.c = way.c AND rows.i = way.i - 1
      )
    )
  )
),
counts AS (
  SELECT c, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (WHERE blank) AS blank,
    COUNT(*) FILTER (WHERE duplicate) AS duplicate, COUNT(*) FILTER (WHERE truncated) AS truncated,
    COUNT(*) FILTER (WHERE NOT last AND role[1] || COALESCE(next, '') NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY c
),
done AS (SELECT counts.*, g0.c AS cost, g0.a AS audit, sha256(array_to_string(g0.t, chr(10))) AS h FROM counts JOIN way ON way.c = counts.c AND way.i = 1)
SELECT o.conv_id, CAST(COALESCE(gaps, 0) AS BIGINT) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
  COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, COALESCE(cost, 0) AS cost, COALESCE(audit, '') AS audit, COALESCE(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done ON done.c = COALESCE(CAST(o.conv_id AS VARCHAR), 'null')
"""


def op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """One pair of steps for each round: nearest entries, moved entries."""
    floored = "(SUM(x) - ((SUM(x) % COUNT(*)) + COUNT(*)) % COUNT(*)) // COUNT(*)"
    steps = ""
    for k in range(rounds + 1):
        steps += f""",
a{k} AS (
  SELECT u, p, MIN(far) AS far, arg_min(e, (far, e)) AS e
  FROM (SELECT part.u, part.p, b.e, CAST(list_sum(list_transform(list_zip(part.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS far FROM part JOIN b{k} b ON b.p = part.p)
  GROUP BY u, p
)"""
        if k < rounds:
            steps += f""",
m{k} AS (
  SELECT p, e, j, CAST({floored} AS BIGINT) AS x
  FROM (SELECT part.p, a.e, unnest(part.x) AS x, unnest(range(len(part.x))) AS j FROM part JOIN a{k} a ON a.u = part.u AND a.p = part.p) GROUP BY p, e, j
),
b{k + 1} AS (
  SELECT b.p, b.e, COALESCE(n.x, b.x) AS x
  FROM b{k} b LEFT JOIN (SELECT p, e, list(x ORDER BY j) AS x FROM m{k} GROUP BY p, e) n ON n.p = b.p AND n.e = b.e
)"""
    return f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS u, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {scale}) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
),
part AS (SELECT u, p, x[p * (len(x) // {parts}) + 1:(p + 1) * (len(x) // {parts})] AS x FROM (SELECT u, x, unnest(range({parts})) AS p FROM v)),
b0 AS (SELECT p, u - 1 AS e, x FROM part WHERE u <= {entries}){steps},
coded AS (SELECT u, CAST(SUM(far) AS BIGINT) AS error, string_agg(lpad(to_hex(e), 2, '0'), '' ORDER BY p) AS code FROM a{rounds} GROUP BY u),
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, lower(code) AS code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM book) AS codebooks_sha256
FROM v JOIN coded ON coded.u = v.u
"""


def op10_sql() -> str:
    """Fixed patterns, the battery of each long token, levels by length class, and the spans."""
    quote = lambda text: "'" + text.replace("'", "''") + "'"

    def places(name: str, pattern: str, words: str, test: str) -> str:
        """Rows (row, s, e, w) of the matches whose ``words`` pass ``test``: gaps and matches alternate."""
        return f"""
{name}_m AS (
  SELECT row, unnest(regexp_extract_all(t, {quote(pattern)})) AS m, unnest(string_split_regex(t, {quote(pattern)})[:-2]) AS gap, unnest({words}) AS w,
    unnest(range(len(regexp_extract_all(t, {quote(pattern)})))) AS i
  FROM docs WHERE regexp_matches(t, {quote(pattern)})
),
{name}_p AS (SELECT row, w, length(m) AS n, SUM(length(gap) + length(m)) OVER (PARTITION BY row ORDER BY i) AS e FROM {name}_m),
{name} AS (SELECT row, CAST(e - n AS BIGINT) AS s, CAST(e AS BIGINT) AS e, w FROM {name}_p WHERE {test}),"""

    whole = lambda pattern: f"regexp_extract_all(t, {quote(pattern)})"
    alphabet = "CASE " + " ".join(f"WHEN regexp_matches(b, {quote(p)}) THEN {quote(a)}" for p, a in s.ENCODINGS) + f" ELSE {quote(s.ENCODINGS[-2][1] + '-_')} END"
    tail = lambda z: f"(1 / (1 + exp(1.5976 * ({z}) + 0.070565776 * ({z}) * ({z}) * ({z}))))"
    held = lambda z: f"greatest(-8.0, least(8.0, {z}))"
    levels = "([" + ", ".join(map(str, s.LEVELS)) + "]::DOUBLE[])"
    fixed = "CASE " + " ".join(f"WHEN 4 * c >= {n} THEN {a}" for n, a in s.FIXED) + " END"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, COALESCE(text, '') AS t FROM documents),
{places("assign", s.ASSIGN, f"regexp_extract_all(t, {quote(s.ASSIGN)}, 2)", f"length(w) >= {s.ASSIGN_VALUE}")}
{places("access", s.ACCESS, whole(s.ACCESS), "true")}
{places("hex", s.HEX, whole(s.HEX), "true")}
{places("token", s.TOKEN, whole(s.TOKEN), "regexp_matches(w, '[A-Za-z]|^[0-9]+$')")}
body AS (SELECT *, regexp_replace(w, '=+$', '') AS b, regexp_matches(w, {quote(s.WORD)}) AS plain, least((e - s) // 4, 16) AS c FROM token),
coded AS (
  SELECT *, CASE WHEN regexp_matches(b, '^[A-Z]+$') THEN {quote(s.UPPER + s.DIGITS[2:8])} WHEN regexp_matches(b, '^[a-z]+$') THEN {quote(s.DIGITS + s.LOWER)}
    WHEN regexp_matches(b, {quote(s.WORD)}) THEN {quote(s.DIGITS + s.UPPER + s.LOWER)} ELSE {alphabet} END AS alpha
  FROM body
),
numbers AS (
  SELECT row, s, e, plain, c, CAST(length(b) AS DOUBLE) AS n, CAST(length(alpha) AS DOUBLE) AS a,
    list_transform(string_split(b, ''), lambda x: CAST(instr(alpha, x) AS DOUBLE)) AS v
  FROM coded
),
sums AS (
  SELECT *, list_sum(list_transform(list_distinct(v), lambda u: pow(len(list_filter(v, lambda y: y = u)), 2))) AS squares,
    CAST(len(list_filter(v, lambda y: y > a / 2)) AS DOUBLE) AS high,
    1.0 + len(list_filter(range(1, len(v)), lambda i: (v[i] > a / 2) <> (v[i + 1] > a / 2))) AS runs,
    list_sum(list_transform(range(1, len(v)), lambda i: (v[i] - (a + 1) / 2) * (v[i + 1] - (a + 1) / 2))) AS product
  FROM numbers
),
scores AS (
  SELECT *, (a / n * squares - n - (a - 1)) / sqrt(2 * (a - 1) * (n - 1) / n) AS chi, product / (sqrt(n - 1) * (a * a - 1) / 12) AS serial,
    2 * high * (n - high) / n + 1 AS expected
  FROM sums
),
spread AS (SELECT *, (expected - 1) * (expected - 2) / (n - 1) AS wide FROM scores),
zs AS (SELECT row, s, e, plain, c, {held("chi")} AS z1, {held("CASE WHEN wide > 0 THEN abs(runs - expected) / sqrt(wide) ELSE 8.0 END")} AS z2, {held("abs(serial)")} AS z3 FROM spread),
half AS (SELECT *, -(ln({tail("z1")}) + ln(least(1.0, 2 * {tail("z2")})) + ln(least(1.0, 2 * {tail("z3")}))) AS h FROM zs),
tested AS (SELECT row, s, e, plain, c, exp(-h) * (1 + h + h * h / 2) AS p FROM half),
counts AS (
  SELECT c, plain, COUNT(*) AS n, COUNT(*) FILTER (WHERE p >= {s.NEAR} AND p < {s.LEVELS[0]}) AS near,
    [{", ".join(f"COUNT(*) FILTER (WHERE p >= {a})" for a in s.LEVELS)}] AS passed
  FROM tested GROUP BY c, plain
),
words AS (
  SELECT k.c, COALESCE(SUM(w.n), 0) AS words, [{", ".join(f"COALESCE(SUM(w.passed[{k + 1}]), 0)" for k in range(len(s.LEVELS)))}] AS wp
  FROM (SELECT unnest(range(4, 17)) AS c) k LEFT JOIN counts w ON w.plain AND w.c <= k.c AND w.c >= 4 GROUP BY k.c
),
own AS (
  SELECT c, n, near, passed, words, wp, CASE WHEN words > wp[1] THEN least(n, (n - passed[1] + 1) / ((words - wp[1]) / words)) ELSE n END AS wrong
  FROM counts JOIN words USING (c) WHERE NOT plain
),
found AS (
  SELECT c, near, list_filter(range(1, {len(s.LEVELS) + 1}), lambda k: passed[k] > 0
    AND least((wp[k] + 1) / (words + 1) * wrong, (near + 1) * -log10({levels}[k])) <= {s.FALSE_SHARE} * passed[k])[1] AS k
  FROM own
),
level AS (SELECT c, CASE WHEN near < {s.FEW} THEN least(COALESCE({levels}[k], 1.0), {fixed}) ELSE {levels}[k] END AS level FROM found),
random AS (SELECT row, s, e FROM tested JOIN level USING (c) WHERE NOT plain AND p >= level),
spans AS (
  SELECT row, s, e, 0 AS k, 'assign' AS kind FROM assign UNION ALL SELECT row, s, e, 1, 'access' FROM access
  UNION ALL SELECT row, s, e, 2, 'hex' FROM hex UNION ALL SELECT row, s, e, 3, 'random' FROM random
),
listed AS (
  SELECT row, COUNT(*) FILTER (WHERE k = 0) AS n_assign, COUNT(*) FILTER (WHERE k = 1) AS n_access, COUNT(*) FILTER (WHERE k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
  sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans
FROM docs LEFT JOIN listed ON listed.row = docs.row
"""


def op9_sql(shingle: int = 3, seed: int = 42, tau: int = 3) -> str:
    """XXH64 of word shingles step by step, majority bits, links by differing bits, components."""
    # The multipliers of XXH64.
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    size = 1 << 64
    wrap = lambda x: f"CAST(({x}) % {size}::UHUGEINT AS UBIGINT)"
    wide = lambda x: f"CAST({x} AS UHUGEINT)"
    mul = lambda x, k: wrap(f"{wide(x)} * {k}::UHUGEINT")
    add = lambda x, y: wrap(f"{wide(x)} + {wide(y)}")
    turn = lambda x, r: f"({mul(x, 1 << r)} | ({x} >> {64 - r}))"
    lane = lambda x: mul(turn(mul(x, p2), 31), p1)
    number = lambda at, n: "CAST('0x' || " + " || ".join(f"substr(h, {at} + {2 * k}, 2)" for k in reversed(range(n))) + " AS UBIGINT)"
    start = lambda v: f"{v % size}::UBIGINT"
    stripe = lambda v, k: mul(turn(add(v, mul(number(f"CAST(64 * x + {16 * k + 1} AS BIGINT)", 8), p2)), 31), p1)
    lanes = "".join(
        f", list_reduce(list_prepend({start(v)}, range(n // 32)::UBIGINT[]), lambda v, x: {stripe('v', k)}) AS v{k}"
        for k, v in enumerate((seed + p1 + p2, seed + p2, seed, seed - p1)))
    steps = ", ".join(f"v{k}" for k in range(4))
    x, four = "x", number("(2 * o + 1)", 4)
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
    list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
),
s AS (SELECT row, array_to_string(ws[p:p + {shingle - 1}], ' ') AS s FROM (SELECT row, ws, unnest(range(1, greatest(1, len(ws) - {shingle - 1}) + 1)) AS p FROM d WHERE len(ws) > 0)),
u AS (SELECT s, hex(encode(s)) AS h, octet_length(encode(s)) AS n FROM (SELECT DISTINCT s FROM s)),
v AS (SELECT s, h, n{lanes} FROM u),
w AS (
  SELECT s, h, n, CASE WHEN n < 32 THEN {start(seed + p5)} ELSE list_reduce(
    list_prepend({wrap(" + ".join(wide(turn(f"v{k}", r)) for k, r in enumerate((1, 7, 12, 18))))}, [{steps}]),
    lambda a, x: {wrap(f"{wide(mul(f'xor(a, {lane(x)})', p1))} + {p4}::UHUGEINT")}) END AS a
  FROM v
),
e AS (SELECT s, h, n, {wrap(f"{wide('a')} + n::UHUGEINT")} AS a, n % 32 // 8 AS eights, n - n % 32 AS base FROM w),
e8 AS (
  SELECT s, h, n, base + 8 * eights AS o, list_reduce(list_prepend(a, list_transform(range(eights), lambda i: {number("(2 * (base + 8 * i) + 1)", 8)})),
    lambda a, x: {wrap(f"{wide(mul(turn(f'xor(a, {lane(x)})', 27), p1))} + {p4}::UHUGEINT")}) AS a
  FROM e
),
e4 AS (
  SELECT s, h, n, CASE WHEN n - o >= 4 THEN o + 4 ELSE o END AS o, CASE WHEN n - o >= 4
    THEN {wrap(f"{wide(mul(turn(f'xor(a, {mul(four, p1)})', 23), p2))} + {p3}::UHUGEINT")} ELSE a END AS a
  FROM e8
),
e1 AS (
  SELECT s, list_reduce(list_prepend(a, list_transform(range(n - o), lambda i: {number("(2 * (o + i) + 1)", 1)})),
    lambda a, x: {mul(turn(f"xor(a, {mul(x, p5)})", 11), p1)}) AS a
  FROM e4
),
f1 AS (SELECT s, {mul("xor(a, a >> 33)", p2)} AS a FROM e1),
f2 AS (SELECT s, {mul("xor(a, a >> 29)", p3)} AS a FROM f1),
f AS (SELECT s, xor(a, a >> 32) AS a FROM f2),
bits AS (SELECT row, COUNT(*) AS n, {", ".join(f"SUM((a >> {b}) & 1) AS b{b}" for b in range(64))} FROM s JOIN f USING (s) GROUP BY row),
majority AS (SELECT row, {" | ".join(f"CASE WHEN 2 * b{b} > n THEN {1 << b}::UBIGINT ELSE 0::UBIGINT END" for b in range(64))} AS fp FROM bits),
fps AS (SELECT doc_id, COALESCE(fp, 0::UBIGINT) AS fp FROM d LEFT JOIN majority USING (row)),
one AS (SELECT fp, MIN(doc_id) AS least FROM fps GROUP BY fp),
link AS (SELECT a.fp AS x, b.fp AS y FROM one a JOIN one b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= {tau}),
reach AS (SELECT fp AS x, fp AS y FROM one UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
root AS (SELECT reach.x AS fp, MIN(one.least) AS component_id FROM reach JOIN one ON one.fp = reach.y GROUP BY reach.x)
SELECT doc_id, lpad(lower(to_hex(fps.fp)), 16, '0') AS fingerprint, component_id FROM fps JOIN root ON root.fp = fps.fp
"""
