"""URL filter: rules first, then a path-template tree for each host.

Paths are generalised from the root down. Below a template a segment stays literal
if it is common there, and becomes ``*`` if it is one of many: a segment of n among
N pages is common if n is at least the square root of N. So a small section of a
very large host keeps a template of its own, and a node with N pages has at most the
square root of N branches. Branches that differ in one literal and go on alike are
merged, the deepest first, where their labelled shares don't differ significantly
from the others' together. A template is rejected by the share of its own and its
merged branches' labelled pages that are blocked, smoothed towards the corpus's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import settle

#: Pages of a segment that stays literal, at least.
SUPPORT = 3
#: What follows this many segments counts as one.
DEPTH = 8
#: Labelled pages from which a branch can be merged with others.
LABELS = 3
#: Pages that the corpus's share weighs in the smoothing.
SMOOTHING = 5.0
#: Smoothed share of blocked pages from which a template is rejected.
REJECT_AT = 0.7
#: Branches are alike up to so many standard errors.
ALIKE = 1.96
ANY, MERGED = "*", "?"  # no path has a question mark; "?+" and "?-" for branches above and below their node's share

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; nulls where none fits.

    ``rules``: (verdict, ``host/path prefix``). A rule fits its host and all its
    subdomains where the path starts with the rule's. Of equally long ones the
    first listed wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1]), reverse=True)[::-1]:
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + prefix))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, segments and more) with the column ``template``: an array of generalised segments.

    One level at a time: counts of segments below each template, partially
    aggregated, then a join on host, template and segment, which Spark splits
    where a host is large. Segments are cut to ``DEPTH`` and a rest beforehand.
    """
    tail = F.array_join(F.slice("segments", DEPTH + 1, F.greatest(F.size("segments"), F.lit(1))), "/")
    paths = paths.withColumn("segments", F.when(F.size("segments") > DEPTH, F.concat(F.slice("segments", 1, DEPTH), F.array(tail))).otherwise(F.col("segments")))
    depth = paths.agg(F.max(F.size("segments"))).first()[0] or 0
    out = paths.withColumn("template", F.array().cast("array<string>"))
    for d in range(depth):
        here = F.get("segments", F.lit(d))
        deeper = out.where(F.size("segments") > d).select("host", "template", here.alias("segment"))
        counts = deeper.groupBy("host", "template", "segment").agg(F.count("*").alias("n"))
        totals = counts.groupBy("host", "template").agg(F.sum("n").alias("total"))
        literal = (
            counts.where(F.col("n") >= SUPPORT).join(totals, ["host", "template"]).where(F.col("n") * F.col("n") >= F.col("total"))
            .select("host", "template", "segment", F.lit(True).alias("literal"))
        )
        joined = out.withColumn("segment", here).join(literal, ["host", "template", "segment"], "left")
        shown = F.when(F.col("literal"), F.col("segment")).otherwise(ANY)
        out = settle(joined.withColumn("template", F.when(F.size("segments") > d, F.concat("template", F.array(shown))).otherwise(F.col("template"))).drop("segment", "literal"), f"templates-{d}")
    return out


def _alike(branches: DataFrame, node: list[str]) -> DataFrame:
    """Branches whose share is within ``ALIKE`` standard errors of that of their node's others together; two of a node at least."""
    totals = branches.groupBy(*node).agg(F.sum("l").alias("tl"), F.sum("b").alias("tb"))
    both = branches.join(totals, node)
    rest, share = F.col("tl") - F.col("l"), F.col("tb") / F.col("tl")
    gap = F.abs(F.col("b") / F.col("l") - F.try_divide(F.col("tb") - F.col("b"), rest))
    alike = both.where(gap <= ALIKE * F.sqrt(share * (1 - share) * (1 / F.col("l") + F.try_divide(F.lit(1.0), rest))))
    several = alike.groupBy(*node).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return alike.join(several, node).drop("tl", "tb")


def merged_branches(nodes: DataFrame) -> DataFrame:
    """``nodes`` (host, template, labelled, blocked) with ``unit``: the template with a mark where branches were merged.

    At each depth, the deepest first, units that differ there alone are branches of
    one node. Those with ``LABELS`` labelled pages or more are tested against all
    others of the node together, and those alike become one unit. Of those left, the
    ones with a larger share than the node, and the ones with a smaller one, are
    tested among themselves in the same way. A branch is tested against the others,
    not against its neighbours in some order, so names and ties decide nothing and no
    chain of small branches joins two that differ.
    """
    depth = nodes.agg(F.max(F.size("template"))).first()[0] or 0
    out = nodes.withColumn("unit", F.col("template"))
    for d in reversed(range(depth)):
        units = out.groupBy("host", "unit").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
        at = F.get("unit", F.lit(d))
        marked = lambda mark, d=d: F.transform("unit", lambda s, i: F.when(i == d, mark).otherwise(s))
        literal = (at != ANY) & ~F.startswith(at, F.lit(MERGED))
        branches = settle(units.where(literal & (F.col("l") >= LABELS)).withColumn("shape", marked(F.lit(MERGED))), f"branches-{d}")
        found = _alike(branches, ["host", "shape"]).select("host", "unit", "shape")
        total = branches.groupBy("host", "shape").agg((F.sum("b") / F.sum("l")).alias("share"))
        left = branches.join(found.select("host", "unit"), ["host", "unit"], "left_anti").join(total, ["host", "shape"])
        sides = left.withColumn("shape", marked(F.when(F.col("b") / F.col("l") >= F.col("share"), MERGED + "+").otherwise(MERGED + "-")))
        found = found.unionByName(_alike(sides.drop("share"), ["host", "shape"]).select("host", "unit", "shape"))
        out = settle(out.join(found, ["host", "unit"], "left").withColumn("unit", F.coalesce("shape", "unit")).drop("shape"), f"units-{d}")
    return out


def purities(nodes: DataFrame) -> DataFrame:
    """``(host, template, blocked_share)`` from labelled counts ``(host, template, n, labelled, blocked)``.

    A unit's share is smoothed towards the corpus's, which is also the share of a
    unit without labels: siblings that are no part of it don't count.
    """
    world = nodes.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    prior = (world.b or 0) / world.l if world.l else 0.0
    units = merged_branches(nodes.select("host", "template", "labelled", "blocked"))
    share = (F.sum("blocked") + SMOOTHING * prior) / (F.sum("labelled") + SMOOTHING)
    shares = units.groupBy("host", "unit").agg(share.alias("blocked_share"))
    return units.join(shares, ["host", "unit"]).select("host", "template", "blocked_share")


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", reject_at: float = REJECT_AT) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, blocked_share)``, a row for each row of ``pages``.

    A page that a rule fits has its verdict, and labels its template; the others
    are blocked if their template's smoothed share of blocked pages reaches
    ``reject_at``. Null urls, and those without ``://``, have an empty host and
    path and the template of that host. A template without labels, merged with none,
    has the corpus's share. Without any label nothing is rejected unless ``reject_at``
    is 0. Repeated rows each count; extra columns are not read; no rows give none.
    """
    host, path = host_and_path(F.coalesce(F.col(url_col).cast("string"), F.lit("")))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("says"), F.filter(F.split("path", "/"), lambda s: s != "").alias("segments"))
    placed = templates(rows)
    nodes = placed.groupBy("host", "template").agg(
        F.count("*").alias("n"), F.count("says").alias("labelled"), F.sum(F.when(F.col("says") == "block", 1).otherwise(0)).alias("blocked"))
    shares = purities(settle(nodes, "template-nodes"))
    verdicts = F.coalesce("says", F.when(F.col("blocked_share") >= reject_at, F.lit("block")).otherwise("allow"))
    shown = F.concat(F.lit("/"), F.array_join("template", "/"))
    return placed.join(shares, ["host", "template"]).select("page_id", "host", "path", "rule", verdicts.alias("verdict"), shown.alias("template"), "blocked_share")
