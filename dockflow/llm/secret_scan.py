"""Secret scan with DataFrame functions only: fixed patterns and a randomness battery.

Patterns find assignments, access keys and long hexadecimal runs. The battery
looks at every other long token: it infers the token's encoding, tests that its
symbols are uniform (chi-squared), and independent (runs about the median, lag-1
serial correlation), and joins the three p-values by Fisher's method. A token is
a secret if randomness can't be rejected at the level of its length class. That
level is set by false-discovery control: tokens of letters of one case, which are
words, pass each level at a known rate in each class. That rate, and the share of
tokens that fail outright, give the words expected among the tokens that pass;
the least level is taken at which they are at most 5 %. The class's own tokens
bound them too: slugs and paths fail far below any level, so tokens that just fail
tell how many more may just pass. Where these are too few for an estimate, a fixed
level by length holds. Short tokens are easily random by chance, so their class
needs a higher level, or none is enough.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import free_name, settle

# The patterns and least lengths of the scan's contract.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
#: An access key is a whole run, so that its least length can be part of the pattern; so with hexadecimal runs.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

TOKEN = "[A-Za-z0-9+/_-]{16,}={0,2}"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings by the characters that a token has, tried in this order: pattern, alphabet.
ENCODINGS = (
    ("^[0-9]+$", DIGITS),
    ("^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[A-Za-z]+$", UPPER + LOWER),
    ("^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
)
#: Letters of one case, the first one aside, are words. Those of both cases inside are tested like any token.
WORD = "^([A-Za-z]?[a-z]+|[A-Z]+)$"
LEVELS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.3, 0.5)
FALSE_SHARE = 0.05
#: Tokens of a class with a p from here to the least level just fail. Words pass level a no more often than log10(1/a) times as
#: many as just fail (1,562 words of 16 to 19 letters in sf0.1: 319 just fail, 636, 389, 135 and 29 pass 0.001, 0.01, 0.1 and 0.5).
NEAR = 1e-6
#: Fewer tokens that just fail are no estimate; then these levels hold, by least length.
FEW = 20
FIXED = ((40, 0.01), (32, 0.03), (24, 0.1), (20, 0.3), (16, 0.5))
BLOCK = 1000
#: Spans that are cut out of one part of a text.
CUT_BLOCK = 128
MASK = "[SECRET]"

SPAN = "struct<s:int,e:int,w:string>"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` on ``value``, which is evaluated once."""
    return F.transform(F.array(value), use)[0]


def _place(items: Column) -> Column:
    """Matches as (gap before, length, text, kept) -> spans of the kept ones.

    Running sums go by blocks, since an array that grows is copied at each step.
    """
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["skip"]
        span = F.when(x["ok"], F.array(F.struct(s.alias("s"), (s + x["n"]).alias("e"), x["w"].alias("w")))).otherwise(none)
        return F.struct((s + x["n"]).alias("at"), F.concat(acc["out"], span).alias("out"))

    def placed(blocks: Column) -> Column:
        lengths = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x["skip"] + x["n"]))
        starts = F.aggregate(lengths, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
        return F.flatten(F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), lambda b, o: F.aggregate(b, F.struct(F.coalesce(o, F.lit(0)).alias("at"), none.alias("out")), step, lambda acc: acc["out"])))

    blocks = F.transform(F.sequence(F.lit(0), ((F.size(items) - 1) / BLOCK).cast("int")), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))
    return _bind(blocks, placed)


def _matches(text: Column, pattern: str, ok: Callable[[Column], Column] | None = None, group: int = 0, words: bool = False) -> Column:
    """Spans of all matches whose ``group`` satisfies ``ok``, found left to right.

    Offsets are code points: what lies between the matches and the matches
    themselves alternate, so that their lengths add up to the places.
    """
    def items(whole: Column) -> Column:
        parts = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), whole, lambda p, w: F.struct(F.length(p).alias("skip"), F.length(w).alias("n"), (w if words else F.lit(None).cast("string")).alias("w"), (ok(w) if ok and not group else F.lit(True)).alias("ok")))
        if not group:
            return parts
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return F.zip_with(parts, value, lambda x, v: F.struct(x["skip"].alias("skip"), x["n"].alias("n"), x["w"].alias("w"), ok(v).alias("ok")))

    found = _bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda whole: _bind(items(whole), _place))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by the usual logistic approximation."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1 / (1 + F.exp(1.5976 * z + 0.070565776 * z * z * z))


def _battery(token: Column) -> Column:
    """A token as (text, alphabet) -> p of its randomness."""
    def joined(x: Column) -> Column:
        n, a, v = x["n"], x["a"], x["v"]
        squares = F.aggregate(F.array_distinct(v), F.lit(0.0), lambda acc, u: acc + F.pow(F.size(F.filter(v, lambda y: y == u)).cast("double"), 2))
        chi = (a / n * squares - n - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
        high = F.size(F.filter(v, lambda y: y > a / 2)).cast("double")
        nexts = F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
        runs = 1.0 + F.size(F.filter(nexts, lambda t: (t["p"] > a / 2) != (t["q"] > a / 2)))
        mean = (a + 1) / 2
        product = F.aggregate(nexts, F.lit(0.0), lambda acc, t: acc + (t["p"] - mean) * (t["q"] - mean))
        serial = product / (F.sqrt(n - 1) * (a * a - 1) / 12)
        expected = 2 * high * (n - high) / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        runs_z = F.when(spread > 0, F.abs(runs - expected) / F.sqrt(F.when(spread > 0, spread))).otherwise(8.0)
        half = -(F.log(_tail(chi)) + F.log(F.least(F.lit(1.0), 2 * _tail(runs_z))) + F.log(F.least(F.lit(1.0), 2 * _tail(F.abs(serial)))))
        return F.exp(-half) * (1 + half + half * half / 2)

    body = F.regexp_replace(token, "=+$", "")
    alphabet = F.coalesce(*(F.when(body.rlike(p), F.lit(s)) for p, s in ENCODINGS), F.lit(ENCODINGS[-2][1] + "-_"))

    def values(x: Column) -> Column:
        return F.struct(F.length(x["b"]).cast("double").alias("n"), F.length(x["a"]).cast("double").alias("a"), F.transform(F.split(x["b"], ""), lambda c: F.instr(x["a"], c)).alias("v"))

    # Words are judged as a token with digits would be.
    wide = F.when(body.rlike("^[A-Z]+$"), F.lit(UPPER + DIGITS[2:8])).when(body.rlike("^[a-z]+$"), F.lit(DIGITS + LOWER)).when(body.rlike(WORD), F.lit(DIGITS + UPPER + LOWER)).otherwise(alphabet)
    return _bind(_bind(F.struct(body.alias("b"), wide.alias("a")), values), joined)


def _tested(tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["w"].rlike(WORD).alias("plain"), _battery(x["w"]).alias("p")))


def _tokens(text: Column) -> Column:
    """Long tokens; of those without a letter the ones of digits alone."""
    return _matches(text, TOKEN, lambda w: w.rlike("[A-Za-z]|^[0-9]+$"), words=True)


def _length_class(span: Column) -> Column:
    return F.least(((span["e"] - span["s"]) / 4).cast("int"), F.lit(16))


def scan_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, assign, access, hex, tokens)``: base spans and tested tokens of each whole text, no text."""
    text = F.coalesce(F.col("t"), F.lit(""))
    return (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
        .select(
            "doc_id",
            _matches(text, ASSIGN, lambda v: F.length(v) >= ASSIGN_VALUE, group=2).alias("assign"),
            _matches(text, ACCESS).alias("access"),
            _matches(text, HEX).alias("hex"),
            _tokens(text).alias("tokens"),
        )
        .withColumn("tokens", _tested(F.col("tokens")))
    )


def levels(spans: DataFrame) -> dict[int, float]:
    """The p from which a token counts as random, by length class; classes without a sound level are left out.

    Words of a class or a shorter one stand for it: the longer, the rarer they
    pass. The lesser of this estimate and the one from tokens that just fail counts.
    """
    near = F.sum(((F.col("t.p") >= NEAR) & (F.col("t.p") < LEVELS[0])).cast("int"))
    counts = [F.count("*").alias("n"), near.alias("near"), *(F.sum((F.col("t.p") >= a).cast("int")).alias(f"n{k}") for k, a in enumerate(LEVELS))]
    rows = spans.select(F.explode("tokens").alias("t")).groupBy(_length_class(F.col("t")).alias("c"), "t.plain").agg(*counts).collect()  # 32 rows at most
    out = {}
    words, passed = 0, [0] * len(LEVELS)
    own = {(r.c, r.plain): r for r in rows}
    for c in range(4, 17):
        if w := own.get((c, True)):
            words += w.n
            passed = [x + w[f"n{k}"] for k, x in enumerate(passed)]
        r = own.get((c, False))
        if not r:
            continue
        # Of the tokens tested, as many are no secrets as words would fail like those that fail outright.
        failing = (words - passed[0]) / words if words else 0.0
        false = min(r.n, (r.n - r.n0 + 1) / failing) if failing else r.n
        for k, a in enumerate(LEVELS):
            if r[f"n{k}"] and min((passed[k] + 1) / (words + 1) * false, (r.near + 1) * -math.log10(a)) <= FALSE_SHARE * r[f"n{k}"]:
                out[c] = a
                break
        if r.near < FEW:
            out[c] = min(out.get(c, 1.0), next(a for n, a in FIXED if 4 * c >= n))
    return out


def _is_random(span: Column, found: dict[int, float]) -> Column:
    level = F.coalesce(*(F.when(_length_class(span) == c, F.lit(a)) for c, a in sorted(found.items())), F.lit(2.0))
    return ~span["plain"] & (span["p"] >= level)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, assign, access, hex, random)``: arrays of (s, e), a row for each row of ``docs``.

    Offsets are code points, ends exclusive. Null and empty texts have empty
    arrays. Ids may be null or repeat; extra columns are not read. Without words
    to compare with, the fixed levels hold.
    """
    spans = settle(scan_spans(docs, id_col, text_col), "secret-spans")
    found = levels(spans)
    ends = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    return spans.select(
        "doc_id", *(F.transform(k, ends).alias(k) for k in KINDS[:3]),
        F.transform(F.filter("tokens", lambda x: _is_random(x, found)), ends).alias("random"),
    )


def listed(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the span columns ``kinds``, by start, then kind, joined by commas."""
    def numbered(i: int, kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))

    names = F.array(*(F.lit(k) for k in kinds))
    text = F.transform(F.array_sort(F.concat(*(numbered(i, k) for i, k in enumerate(kinds)))), lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string")))
    return F.array_join(text, ",")


def _cut(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with ``mask`` in place of each of the sorted ``spans``, overlapping ones as one.

    Parts of the text go with blocks of spans, since a place is sought from the start of its string.
    """
    def part(block: Column, at: Column) -> Column:
        def step(acc: Column, x: Column, own: Column) -> Column:
            gap = F.substring(own, acc["at"] - at + 1, x["s"] - acc["at"])
            shown = F.when(x["s"] >= acc["at"], F.concat(gap, F.lit(mask))).otherwise("")
            return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], F.array(shown)).alias("out"))

        start = F.struct(at.alias("at"), F.array().cast("array<string>").alias("out"))
        whole = F.substring(text, at + 1, F.greatest(F.lit(0), F.array_max(F.transform(block, lambda x: x["e"])) - at))
        return _bind(whole, lambda own: F.aggregate(block, start, lambda acc, x: step(acc, x, own), lambda acc: F.array_join(acc["out"], "")))

    def joined(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda x: x["e"])))
        reach = F.aggregate(ends, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), v))))

        def whole(r: Column) -> Column:
            parts = F.zip_with(blocks, F.slice(r, 1, F.size(blocks)), lambda b, at: part(b, F.coalesce(at, F.lit(0))))
            return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(r, -1) + 1, F.length(text)))

        return _bind(reach, whole)

    def blocks(spans: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), ((F.size(spans) - 1) / CUT_BLOCK).cast("int")), lambda b: F.slice(spans, b * CUT_BLOCK + 1, CUT_BLOCK))

    return _bind(spans, lambda x: F.when(F.size(x) > 0, _bind(blocks(x), joined)).otherwise(text))


def redact(docs: DataFrame, text_col: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every secret of ``text_col`` replaced by ``mask``; all rows and columns stay.

    The text is cut once at the spans that ``scan`` finds in it, overlapping
    ones as one; of assignments the keyword goes too. An assignment whose value
    is another's keyword (``token:token: value``) goes as well. Null texts stay
    null, empty ones empty. Rows that repeat are treated alike; levels come from all
    rows. Extra columns may have any name; an empty table stays empty.
    """
    text, at = F.col(text_col), free_name(docs, "found")
    value = ASSIGN.removesuffix("+)") + f"{{{ASSIGN_VALUE},}})"
    ends = lambda k: F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    fixed = (_matches(text, ASSIGN, lambda v: F.length(v) >= ASSIGN_VALUE, group=2), _matches(text, value), _matches(text, ACCESS), _matches(text, HEX))
    # Patterns and tests run once: what they find is written beside the rows before the levels are known.
    known = settle(docs.withColumn(at, F.struct(F.concat(*map(ends, fixed)).alias("fixed"), _tested(_tokens(text)).alias("tokens"))), "secret-tokens")
    found = levels(known.select(F.col(f"{at}.tokens").alias("tokens")))
    spans = F.array_sort(F.concat(F.col(f"{at}.fixed"), ends(F.filter(F.col(f"{at}.tokens"), lambda x: _is_random(x, found)))))
    return known.withColumn(text_col, F.when(text.isNotNull(), _cut(text, spans, mask))).drop(at)
