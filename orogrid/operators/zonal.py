"""Zonal operations: connected components of flags and what is built on them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.operators import focal, grid
from orogrid.plans.scratch import Rounds

#: Steps to half of the neighbours; the other half follow by symmetry.
_HALF = {4: [(0, 1), (1, 0)], 8: [(0, 1), (1, 0), (1, 1), (1, -1)]}

#: Rounds of `components`, about the logarithm of the longest path of runs; more raise an error rather than split components.
MOST_ROUNDS = 60

#: Edges between the blocks of one raster up to which one task joins them; more take the rounds.
MOST_HELD = 1_000_000


def _runs(df: DataFrame, flag: Column) -> DataFrame:
    """(rid, r, a, b): runs of set pixels within a row. A long feature is a few runs, so rounds work on far fewer rows."""
    on = df.where(flag).select(*grid.KEY)
    w = grid.along_row()
    on = on.withColumn("_g", F.col("c") - F.row_number().over(w))
    return on.groupBy("rid", "r", "_g").agg(F.min("c").alias("a"), F.max("c").alias("b")).drop("_g")


def _least_roots(pdf: pd.DataFrame) -> pd.DataFrame:
    """(rid, node, root): the least node joined to each node of the edges (rid, u, v) of one raster."""
    nodes, at = np.unique(pdf[["u", "v"]].to_numpy(), return_inverse=True)
    u, v = at.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while (root[u] != root[v]).any():
        a, b = root[u], root[v]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return pd.DataFrame({"rid": pdf["rid"].iloc[0], "node": nodes, "root": nodes[root]})


def components(df: DataFrame, flag: Column, connectivity: int = 8) -> DataFrame:
    """(rid, r, c, label, size) of all set pixels; label: the least (row, column) of the component's runs as one number.

    Runs of neighbouring rows that touch are joined, first within blocks of 1024 x 1024 pixels, each in
    one task, then the parts of blocks over the edges between blocks. Where these are more than
    MOST_HELD, large-star and small-star rounds join them: each halves the distance to the least
    member, so a few rounds do for any shape.
    """
    rounds = Rounds(df.sparkSession)
    slack = 1 if connectivity == 8 else 0
    node = (F.col("r").cast("long") * F.lit(1 << 32) + F.col("a")).alias("node")
    runs = rounds.keep(_runs(df, flag).select("*", node))
    # touching runs of two rows: both are cut at the borders of 256 columns, so that the join is on equal keys
    width = 256
    cells = runs.select("rid", "r", "a", "b", "node", F.explode(F.sequence(F.floor((F.col("a") - slack) / width), F.floor((F.col("b") + slack) / width))).alias("cell"))
    lower = cells.select("rid", (F.col("r") - 1).alias("r"), F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("node").alias("v"), "cell")
    touch = (F.col("a") <= F.col("b2") + slack) & (F.col("a2") <= F.col("b") + slack)
    edges = cells.join(lower, ["rid", "r", "cell"]).where(touch).select("rid", F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v")).distinct()
    loop = Rounds(df.sparkSession)
    edges = loop.keep(edges)
    kind = f"rid {df.schema['rid'].dataType.simpleString()}, node long, root long"
    block = lambda n: F.struct(F.shiftright(n, 42), F.shiftright(F.col(n).bitwiseAND(0xFFFFFFFF), 10))
    within = edges.where(block("u") == block("v"))
    parts = rounds.keep(within.groupBy("rid", block("u")).applyInPandas(_least_roots, kind))
    edges = edges.where(block("u") != block("v"))
    for end in ("u", "v"):
        part = parts.select("rid", F.col("node").alias(end), "root")
        edges = edges.join(part, ["rid", end], "left").withColumn(end, F.coalesce("root", end)).drop("root")
    edges = loop.keep(edges.select("rid", F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    if (edges.groupBy("rid").count().agg(F.max("count")).first()[0] or 0) <= MOST_HELD:
        joined = loop.keep(edges.groupBy("rid").applyInPandas(_least_roots, kind))
    else:
        joined = _star_rounds(edges, loop).select("rid", F.col("u").alias("node"), F.col("v").alias("root"))
    part, whole = parts.select("rid", "node", F.col("root").alias("part")), joined.select("rid", F.col("node").alias("part"), "root")
    named = runs.join(part, ["rid", "node"], "left").withColumn("part", F.coalesce("part", "node"))
    named = named.join(whole, ["rid", "part"], "left").withColumn("label", F.coalesce("root", "part"))
    sizes = named.groupBy("rid", "label").agg(F.sum(F.col("b") - F.col("a") + 1).alias("size"))
    named = named.join(sizes, ["rid", "label"])
    return named.select("rid", "r", F.explode(F.sequence("a", "b")).alias("c"), "label", "size")


def _star_rounds(edges: DataFrame, loop: Rounds) -> DataFrame:
    """(rid, u, v): the least node v joined to each node u of the edges (u over v)."""
    last = None
    for _ in range(MOST_ROUNDS):
        both = edges.select("rid", "u", "v").union(edges.select("rid", F.col("v"), F.col("u")))
        least = both.groupBy("rid", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, ["rid", "u"]).select("rid", F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("rid", "u").agg(F.min("v").alias("m"))
        small = large.join(low, ["rid", "u"])
        edges = small.where("v <> m").select("rid", F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("rid", "u", F.col("m").alias("v"))).distinct()
        edges = loop.keep(edges)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("rid", "u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            return edges
        last = now
    raise RuntimeError(f"components: not finished after {MOST_ROUNDS} rounds")


def area_open(df: DataFrame, flag: str, least: int, connectivity: int = 8, out: str | None = None) -> DataFrame:
    """The flag without components of fewer than `least` pixels."""
    big = components(df, F.coalesce(F.col(flag), F.lit(False)), connectivity).where(F.col("size") >= least).select(*grid.KEY, F.lit(True).alias("_big"))
    return df.join(big, list(grid.KEY), "left").withColumn(out or flag, F.coalesce("_big", F.lit(False))).drop("_big")


def fill_holes(df: DataFrame, flag: str, out: str | None = None, frame: tuple[int, int, int, int] | None = None) -> DataFrame:
    """The flag, also set where unset pixels are cut off (by sides) from the raster's border.

    frame: first and last row and column that are the border, where that is not the end of the table."""
    parts = components(df, ~F.coalesce(F.col(flag), F.lit(False)), 4)
    if frame:
        border = F.col("r").isin(*frame[:2]) | F.col("c").isin(*frame[2:])
    else:
        parts, border = parts.join(grid.extent(df), "rid"), grid.is_border()
    outside = parts.where(border).select("rid", "label").distinct().withColumn("_out", F.lit(True))
    holes = parts.join(outside, ["rid", "label"], "left").where("_out is null").select(*grid.KEY, F.lit(True).alias("_hole"))
    return df.join(holes, list(grid.KEY), "left").withColumn(out or flag, F.coalesce(F.col(flag), F.lit(False)) | F.coalesce("_hole", F.lit(False))).drop("_hole")


def drop_gaps(df: DataFrame, flag: str, least: int) -> DataFrame:
    """The flag, also set in unset components of fewer than `least` pixels."""
    df = df.withColumn("_not", ~F.coalesce(F.col(flag), F.lit(False)))
    return area_open(df, "_not", least).withColumn(flag, ~F.col("_not")).drop("_not")


def clean_mask(df: DataFrame, flag: str, remove: int, fill: int) -> DataFrame:
    """Small components removed, then small gaps filled."""
    return drop_gaps(area_open(df, flag, remove), flag, fill)


def envelope(df: DataFrame, mask: str, nodata: str, edge: str | None = None) -> DataFrame:
    """The mask with the nodata pixels that touch it by a side. edge: those on it don't count, holes between them do."""
    cross = [[0, 1, 0], [1, 1, 1], [0, 1, 0]]
    grown = focal.morph(df.withColumn("_i", F.coalesce(F.col(mask), F.lit(False)).cast("int")), "_i", cross, "max", "_g")
    df = df.join(grown, list(grid.KEY)).withColumn("_add", (F.col("_g") > 0) & F.col(nodata))
    if edge is not None:
        df = fill_holes(df.withColumn("_add", F.col("_add") & ~F.coalesce(F.col(edge), F.lit(False))), "_add")
        df = df.withColumn("_add", F.col("_add") & F.col(nodata))
    return df.withColumn(mask, F.coalesce(F.col(mask), F.lit(False)) | F.col("_add")).drop("_g", "_add")


def reconstruct(df: DataFrame, seed: str, allowed: str, k: int, out: str | None = None) -> DataFrame:
    """The seed grown by k x k steps within the allowed pixels until it no longer changes.

    A step reaches k // 2 pixels in each direction, over gaps. With k = 3 that is the allowed components
    that hold a seed, which takes no loop; others grow round by round, each one written."""
    allow = F.coalesce(F.col(allowed), F.lit(False))
    start = F.coalesce(F.col(seed), F.lit(False))
    if k == 3:
        grown = focal.dilate(df.withColumn("_s", start.cast("int")), "_s", 3)
        parts = components(grown, allow, 8).join(grown.select(*grid.KEY, "_s"), list(grid.KEY))
        hit = parts.where("_s > 0").select("rid", "label").distinct()
        full = parts.join(hit, ["rid", "label"]).select(*grid.KEY, F.lit(True).alias("_in"))
        return df.join(full, list(grid.KEY), "left").withColumn(out or seed, F.coalesce("_in", F.lit(False))).drop("_in")
    rounds = Rounds(df.sparkSession)
    state = rounds.keep(df.withColumn("_s", start.cast("int")).withColumn("_ok", allow))
    last = -1
    while True:
        state = rounds.keep(focal.dilate(state, "_s", k).withColumn("_s", F.when(F.col("_ok"), F.col("_s")).otherwise(0)))
        now = state.agg(F.sum("_s")).first()[0] or 0
        if now == last:
            break
        last = now
    return state.withColumn(out or seed, F.col("_s") > 0).drop("_s", "_ok")
