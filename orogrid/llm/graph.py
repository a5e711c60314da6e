"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orogrid.llm._shared import Scratch


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges(a, b); root is the least node of the component.

    Each round only takes the least neighbour of a node (an aggregate that combines on the map
    side) and links the others to it, so a node with very many neighbours makes no more rows than
    it has edges. The graph shrinks to stars in about log(longest path) rounds.
    Nulls and loops are left out; an empty table gives an empty one. A graph that is not finished
    after `rounds` raises an error rather than returning split components.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = scratch.keep(e, "edges-0")
    last, before = None, "edges-0"
    for i in range(1, rounds + 1):
        # large star: the larger neighbours of every node go to its least neighbour
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its smaller neighbours go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        e = scratch.keep(e, f"edges-{i}")
        scratch.drop(before)
        before = f"edges-{i}"
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components: not finished after {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
