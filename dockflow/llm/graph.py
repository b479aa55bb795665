"""Connected components by random-order contraction, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import settle


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(a, b)`` long links -> ``(node, root)``, one row per node that has a link.

    Each round lets every node follow its neighbour (or itself) that comes first
    in an order hashed anew for the round, then rewrites the links between those
    leaders and drops loops and repeats. A fresh random order shrinks chains and
    stars alike, so the number of rounds grows with the logarithm of the size of
    the largest component. Every round is a partial aggregation and joins on a
    node, written to the checkpoint folder; nothing is collected but a count.
    Links that hold a null, and loops, are ignored; no links give no rows.
    """
    links = settle(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(),
        "links",
    )
    maps: list[DataFrame] = []
    for k in range(max_rounds):
        if links.isEmpty():
            break
        order = lambda c, k=k: F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("id"))
        ends = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
        best = links.select(ends.alias("e")).select("e.x", "e.y").groupBy("x").agg(F.min(order("y")).alias("m"))
        step = settle(best.select(F.col("x").alias("node"), F.least(F.col("m"), order("x"))["id"].alias("up")), f"leaders-{k}")
        maps.append(step)
        up_a = step.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        up_b = step.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        moved = links.join(up_a, "a").join(up_b, "b").where("ua <> ub")
        links = settle(moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), f"links-{k}")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0].select("node", F.col("up").alias("root"))
    for step in maps[1:]:
        nxt = step.select(F.col("node").alias("root"), "up")
        out = out.join(nxt, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return settle(out, "components") if len(maps) > 1 else out
