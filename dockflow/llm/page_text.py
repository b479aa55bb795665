"""Main text of HTML pages by nearest-URL differencing and page structure.

Every page is cut into text lines (one a block). Within each host the pages are
ordered by URL path, each is paired with the nearest paths before and after it,
and the pair's lines are aligned by a longest common subsequence. Lines that a
page shares with a neighbour outside a marked article are template and go.

Differencing alone can't tell a passage that two articles both quote from a
template line, nor see a menu or advert that changes with each page. Structure
settles these: lines inside ``article`` or ``main`` are no template, and lines
inside menus, footers, asides, forms and the like go. Of what is left the articles
stay alone unless ``main`` has more text beside them, and these stay alone unless
the rest of the page has more, so that a small card doesn't displace the text.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.base import map_batches, map_stream, settle
from dockflow.llm.url_templates import host_and_path

#: A comment, a raw-text element with its content, a tag, an unfinished tag at the end, or text.
PARTS = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title|textarea|iframe|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/a-zA-Z][^>]*+(?:>|\Z)|[^<]++|<""",
    re.S | re.I,
)
#: Name and value of an attribute.
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORDS = re.compile(r"[^a-z0-9]+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
ASIDE = frozenset("nav footer aside form button select menu dialog object head".split())
HOLDERS = frozenset(("html", "body", "main", "article"))
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
#: Reader comments by class or id, wherever they are.
COMMENTS = frozenset("comment comments commentlist comment-list comments-area comments-section comment-respond respond disqus disqus_thread replies".split())
#: What a class, id or role may name beside the main text also inside it, as a whole.
INSIDE = COMMENTS | frozenset("ad ads advert adverts advertisement advertising sponsored sponsor sidebar share sharing newsletter subscribe navigation menu breadcrumb breadcrumbs".split())
#: Words of a class, id or role that name something beside the main text where neither an article nor main is open.
MARKS = INSIDE | frozenset("promo banner cookie cookies consent gdpr notice alert nav navbar footer contentinfo complementary social related popup modal search toolbar".split())


def _aside(tag: str, attributes: str, level: int) -> bool:
    if tag in ASIDE or (tag == "header" and not level):
        return True
    if not attributes or tag in HOLDERS - {"article"}:
        return False
    names, words = set(), set()
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" and not value.startswith("until"):
            return tag not in HOLDERS
        if name in ("class", "id", "role"):
            names.update(value.split())
            words.update(WORDS.split(value))
    if tag == "article":
        return bool(names & COMMENTS)
    return bool(names & INSIDE) if level else bool((names | words) & MARKS)


class _Block:
    """An open block element with the inline elements open in it: (tag, aside), and how many of each tag."""

    __slots__ = ("tag", "level", "aside", "header", "inline", "count")

    def __init__(self, tag: str, level: int, aside: bool, header: int):
        self.tag, self.level, self.aside, self.header = tag, level, aside, header
        self.inline: list[tuple[str, bool]] = []
        self.count: dict[str, int] = {}


def lines_of(page: str | None) -> list[tuple[str, int, bool]]:
    """``(text, level, aside)`` of each non-empty block of a page, in order.

    Level: 2 inside ``article``, 1 inside ``main``, else 0. A ``header`` inside them
    is aside unless it holds a heading. Character references are decoded and white
    space is one space. Unclosed and stray tags, unfinished tags and pages cut
    anywhere are read as far as they go. The work is linear in the page: open
    elements are counted by tag, so an end tag without a start costs nothing, and any
    other closes what it passes.
    """
    out: list[tuple[str, int, bool, int]] = []
    stack = [_Block("", 0, False, 0)]
    opened: dict[str, int] = {}
    headed: set[int] = set()  # headers that hold a heading
    headers = 0
    held: list[str] = []

    def flush() -> None:
        if held:
            text = " ".join(html_entities.unescape("".join(held)).split())
            held.clear()
            if text:
                top = stack[-1]
                out.append((text, top.level, top.inline[-1][1] if top.inline else top.aside, top.header))

    def close() -> _Block:
        gone = stack.pop()
        opened[gone.tag] -= 1
        return gone

    for m in PARTS.finditer(page or ""):
        raw, closing, tag, attributes = m.groups()
        if tag is None:
            part = m.group()
            if raw is None and (part[0] != "<" or part == "<"):
                held.append(part)
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        elif tag in ("br", "img", "wbr"):
            held.append(" ")
        if tag in VOID:
            continue
        top = stack[-1]
        if closing:
            if tag in INLINE:  # an inline end tag doesn't close blocks
                while top.count.get(tag):
                    name, _ = top.inline.pop()
                    top.count[name] -= 1
                    if name == tag:
                        break
            elif opened.get(tag):
                while close().tag != tag:
                    pass
            continue
        if tag not in INLINE and top.tag == "p":  # a block ends an open paragraph
            close()
            top = stack[-1]
        if attributes.endswith("/") and tag not in HOLDERS:
            continue
        aside = top.inline[-1][1] if top.inline else top.aside
        if tag in INLINE:
            top.inline.append((tag, aside or _aside(tag, attributes, top.level)))
            top.count[tag] = top.count.get(tag, 0) + 1
            continue
        header = top.header
        if tag == "header" and top.level:
            headers += 1
            header = headers
        elif tag in HEADINGS and header:
            headed.add(header)
        level = max(top.level, 2 if tag == "article" else 1 if tag == "main" else 0)
        stack.append(_Block(tag, level, aside or _aside(tag, attributes, top.level), header))
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    return [(text, level, aside or bool(header and header not in headed)) for text, level, aside, header in out]


def common_lines(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two hash sequences.

    Lines that only one side has are left out first; rows of the table are bit
    vectors, and a table that is too large is halved (Hirschberg), so memory
    stays linear.
    """
    both = np.intersect1d(a, b)
    ia, ib = np.flatnonzero(np.isin(a, both)), np.flatnonzero(np.isin(b, both))
    x, y = a[ia].tolist(), b[ib].tolist()

    def rows(p: list[int], q: list[int], keep: bool) -> list[int]:
        """Bit j of a row is 0 where the prefix of q ending at j gains one more common line."""
        full = (1 << len(q)) - 1
        where: dict[int, int] = {}
        for j, v in enumerate(q):
            where[v] = where.get(v, 0) | (1 << j)
        v, out = full, []
        for item in p:
            u = v & where.get(item, 0)
            v = ((v + u) | (v - u)) & full
            if keep:
                out.append(v)
        return out if keep else [v]

    def zeros(v: int, n: int) -> np.ndarray:
        bits = np.unpackbits(np.frombuffer(v.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
        return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])

    found: list[tuple[int, int]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and x[a0] == y[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and x[a1 - 1] == y[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        if (a1 - a0) * (b1 - b0) > 1 << 26 and a1 - a0 > 1:
            mid, n = (a0 + a1) // 2, b1 - b0
            ahead = zeros(rows(x[a0:mid], y[b0:b1], False)[0], n)
            behind = zeros(rows(x[mid:a1][::-1], y[b0:b1][::-1], False)[0], n)
            cut = b0 + int(np.argmax(ahead + behind[::-1]))
            todo += [(a0, mid, b0, cut), (mid, a1, cut, b1)]
            continue
        table, j = rows(x[a0:a1], y[b0:b1], True), b1 - b0
        full = (1 << j) - 1
        for i in range(a1 - a0 - 1, -1, -1):
            above = table[i - 1] if i else full
            # The last place up to j that this row has gained over the one above starts its match.
            while j and not (~table[i] >> (j - 1)) & 1:
                j -= 1
            if not j:
                break
            ones = lambda v, k: k - (v & ((1 << k) - 1)).bit_count()
            if ones(table[i], j) == ones(above, j):
                continue
            while x[a0 + i] != y[b0 + j - 1]:
                j -= 1
            found.append((a0 + i, b0 + j - 1))
            j -= 1
    return [(int(ia[p]), int(ib[q])) for p, q in sorted(found)]


def _hashes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The hashes of a page's lines outside a marked article."""
    out = [[xxhash.xxh64_intdigest(t) - (1 << 63) for t, level, _ in lines_of(p) if not level] for p in batch.column("html").to_pylist()]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("host", "path", "key")), pa.array(out, pa.list_(pa.int64()))], ["host", "path", "key", "lines"])


def template_lines(pages: DataFrame) -> DataFrame:
    """``(key, shared)``: hashes of the lines that a page shares with its neighbours.

    ``pages``: key, host, path, html. Of pages with one host and path the one of
    least key stands for them among the neighbours. Neighbours come from a
    global order by host and path in which each page knows its rank, so that a
    host of any size is spread evenly.
    """
    lines = map_batches(pages.select("host", "path", "key", "html"), _hashes, "host string, path string, key long, lines array<long>")
    lines = settle(lines.where(F.size("lines") > 0).dropDuplicates(["key"]), "page-lines")
    first = lines.groupBy("host", "path").agg(F.min("key").alias("key"))
    order = first.repartitionByRange("host", "path").sortWithinPartitions("host", "path")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], [*b.schema.names, "part", "seq"])
            at += n

    placed = settle(map_stream(order, number, "host string, path string, key long, part int, seq long"), "page-order")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))  # a row for each task
    bases = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    ranked = placed.join(F.broadcast(bases), "part").select("host", "path", "key", (F.col("base") + F.col("seq")).alias("rank"))
    # Every page, with the rank of its path, against the page that stands for the next and the previous path.
    own = lines.join(ranked.select("host", "path", "rank"), ["host", "path"])
    stand = ranked.select("rank", "key", F.col("host").alias("near_host")).join(lines.select("key", F.col("lines").alias("near")), "key").drop("key")
    asked = own.select("key", "host", "lines", F.explode(F.array(F.col("rank") - 1, F.col("rank") + 1)).alias("rank"))
    pairs = asked.join(stand, "rank").where("host = near_host").select("key", "lines", "near")

    def shared(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, lines_a, lines_b = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        out = [sorted({a[i] for i, _ in common_lines(np.array(a, np.int64), np.array(b, np.int64))}) for a, b in zip(lines_a, lines_b, strict=True)]
        return pa.RecordBatch.from_arrays([keys, pa.array(out, pa.list_(pa.int64()))], ["key", "shared"])

    found = map_batches(pairs, shared, "key long, shared array<long>").where(F.size("shared") > 0)
    return found.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_set("shared"))).alias("shared"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row for each row of ``pages``.

    ``text``: the main blocks in page order, joined by a line feed; empty for
    null and empty pages and those without main text. Pages without a host are
    one host of their own; null urls too. Rows of one host and path are no
    neighbours of each other, so repeated rows keep their text. Extra columns
    are not read.
    """
    host, path = host_and_path(F.coalesce(F.col("url"), F.lit("")))
    page = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    page = page.select("page_id", "url", "html", host.alias("host"), path.alias("path"), F.xxhash64("url", "html").alias("key"))
    found = template_lines(page.select("key", "host", "path", "html"))

    def blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, levels, hashes = [], [], []
        for p in batch.column("html").to_pylist():
            lines = [x for x in lines_of(p) if not x[2]]
            texts.append([t for t, _, _ in lines])
            levels.append([level for _, level, _ in lines])
            hashes.append([None if level else xxhash.xxh64_intdigest(t) - (1 << 63) for t, level, _ in lines])
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("key"), pa.array(texts, pa.list_(pa.string())), pa.array(levels, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))],
            ["page_id", "url", "key", "blocks", "levels", "hashes"])

    kind = dict(page.dtypes)["page_id"]
    cut = map_batches(page.select("page_id", "url", "html", "key"), blocks, f"page_id {kind}, url string, key long, blocks array<string>, levels array<int>, hashes array<long>")
    joined = cut.join(found, "key", "left")
    lines = F.arrays_zip("blocks", "levels", "hashes")
    kept = F.when(F.col("shared").isNull(), lines).otherwise(F.filter(lines, lambda x: x["hashes"].isNull() | ~F.array_contains("shared", x["hashes"])))

    def chars(level: int) -> Column:
        return F.aggregate(F.filter("kept", lambda x: x["levels"] == level), F.lit(0), lambda n, x: n + F.length(x["blocks"]))

    sized = joined.select("page_id", "url", kept.alias("kept")).select("*", F.array(*map(chars, range(3))).alias("held"))
    rest, main, article = (F.col("held")[k] for k in range(3))
    top = F.when((article > 0) & (article >= main), 2).otherwise(1)
    least = F.when(rest > F.when(top == 2, article).otherwise(article + main), 0).otherwise(top)
    least = F.when(article + main > 0, least).otherwise(0)
    chosen = sized.select("page_id", "url", "kept", least.alias("least"))
    text = F.array_join(F.transform(F.filter("kept", lambda x: x["levels"] >= F.col("least")), lambda x: x["blocks"]), "\n")
    return chosen.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
