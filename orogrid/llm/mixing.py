"""Mixing sources to target weights as a min-cost flow from document groups to source quotas."""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.llm import _words as W
from orogrid.llm._shared import Scratch

#: Copies of a document that the mix may hold. The n-th copy costs n - 1 for each word.
COPIES = 3
#: Membership patterns (sets of sources that occur together) that the driver holds, a few hundred bytes each, and those
#: among them that the flow may have: patterns whose sources no other pattern shares need none.
MOST_PATTERNS, MOST_FLOW = 500_000, 4_000
#: Bits of the seeded order settled in one pass over the numbers, and passes until single values are left.
BITS, LEVELS = 12, 4


def count_words(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """(row, size): row is a struct of all columns (keep_text: the text, too), size the number of words (null: 0)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if keep_text or c != text_col]).alias("row")

    def run(batches):
        for batch in batches:
            for at, to, t in W.texts(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(t.counts.astype(np.int64))], ["row", "size"])

    data = docs.select(row, F.col(text_col).cast("string").alias("text"))
    return data.mapInArrow(run, f"row {data.schema['row'].dataType.simpleString()}, size long")


def water_fill(sizes: list[int], weights: list[float], copies: int = COPIES) -> list[float]:
    """Targets that share sum(sizes) by weight; none is above copies times its size, and the excess is shared again by weight."""
    targets, open_, rest = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        share = sum(weights[i] for i in open_)
        full = [i for i in open_ if rest * weights[i] / share > copies * sizes[i]]
        for i in full or open_:
            targets[i] = float(copies * sizes[i]) if full else rest * weights[i] / share
        if not full:
            break
        rest -= sum(targets[i] for i in full)
        gone = set(full)
        open_ = [i for i in open_ if i not in gone]
    return targets


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], copies: int = COPIES) -> list[dict[int, int]]:
    """Words of each pattern (its sources, its words) that count for each source, at the least repetition cost.

    Min-cost flow by successive shortest paths with potentials: source node -> pattern over one edge
    for each copy (capacity: the pattern's words, cost: copy - 1), pattern -> its sources -> sink
    (capacity: the quota). Costs are convex, so no copy is used before the one below it."""
    p, s = len(patterns), len(quotas)
    start, end = p + s, p + s + 1
    to, cap, cost, out = [], [], [], [[] for _ in range(p + s + 2)]

    def edge(a: int, b: int, c: int, w: int) -> int:
        for x, y, z, v in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(to))
            to.append(y)
            cap.append(z)
            cost.append(v)
        return len(to) - 2

    uses: list[dict[int, int]] = []
    for i, (members, size) in enumerate(patterns):
        for c in range(copies):
            edge(start, i, size, c)
        uses.append({j: edge(i, p + j, copies * size, 0) for j in members})
    for j, q in enumerate(quotas):
        edge(p + j, end, q, 0)
    high = [0] * len(out)
    while True:
        dist, via = {start: 0}, {}
        heap, done = [(0, start)], set()
        while heap:
            d, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            for e in out[x]:
                if cap[e] > 0 and (n := d + cost[e] + high[x] - high[to[e]]) < dist.get(to[e], 1 << 60):
                    dist[to[e]], via[to[e]] = n, e
                    heapq.heappush(heap, (n, to[e]))
        if end not in done:
            break
        far = dist[end]
        for x in range(len(out)):
            high[x] += min(dist.get(x, far), far)
        x, path = end, []
        while x != start:
            path.append(via[x])
            x = to[via[x] ^ 1]
        most = min(cap[e] for e in path)
        for e in path:
            cap[e] -= most
            cap[e ^ 1] += most
    return [{j: cap[e ^ 1] for j, e in use.items()} for use in uses]


def _flow(members: list[tuple[int, ...]], total: list[int], quotas: list[int], copies: int = COPIES) -> list[dict[int, int]]:
    """As `route`, over those patterns alone whose sources several patterns share."""
    uses = Counter(i for m in members for i in m)
    alone = [len(m) == 1 and uses[m[0]] == 1 for m in members]
    shared = [k for k, a in enumerate(alone) if not a]
    if len(shared) > MOST_FLOW:
        raise ValueError(f"over {MOST_FLOW} membership patterns with sources in common; group the sources first")
    used = sorted({i for k in shared for i in members[k]})
    number = {s: j for j, s in enumerate(used)}
    routed = route([(tuple(number[i] for i in members[k]), total[k]) for k in shared], [quotas[i] for i in used], copies)
    out = [{m[0]: min(quotas[m[0]], copies * n)} if a else {} for m, n, a in zip(members, total, alone, strict=True)]
    for k, use in zip(shared, routed, strict=True):
        out[k] = {used[j]: n for j, n in use.items()}
    return out


def _fill(rows: DataFrame, needs: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(pid, below): rows with draw < below have at most need words together; found by LEVELS histogram passes.

    Each pass splits the bucket in which the sum passes the need into 2**BITS; nothing is sorted or
    gathered but one number for each pattern and bucket."""
    at = needs.select("pid", "need", F.lit(0).cast("long").alias("below"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - level - 1)
        inside = rows.join(F.broadcast(at), "pid")  # a row for each pattern: MOST_PATTERNS at most
        inside = inside.where("draw >= below" if not level else f"shiftright(draw, {shift + BITS}) = shiftright(below, {shift + BITS})")
        bucket = inside.groupBy("pid", F.shiftright("draw", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        listed = bucket.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("bucket", "words"))).alias("list"))  # at most 2**BITS for each pattern
        step = F.aggregate(
            "list",
            F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("at")),
            lambda a, x: F.when(a["at"].isNotNull(), a).when(a["sum"] + x["words"] > F.col("need"), F.struct(a["sum"].alias("sum"), x["bucket"].alias("at"))).otherwise(F.struct((a["sum"] + x["words"]).alias("sum"), a["at"].alias("at"))),
        )
        now = at.join(listed, "pid", "left").withColumn("step", step)
        top = F.shiftleft(F.shiftright("below", shift + BITS) + 1, shift + BITS) if level else F.lit(1 << (BITS * LEVELS)).cast("long")
        below = F.when(F.col("list").isNull(), F.col("below")).when(F.col("step.at").isNull(), top).otherwise(F.shiftleft("step.at", shift))
        at = scratch.keep(now.select("pid", (F.col("need") - F.coalesce("step.sum", F.lit(0))).alias("need"), below.cast("long").alias("below")), f"{tag}-{level}")
    return at


def mix(sized: DataFrame, sources: Column, weights: list[float] | None = None, seed: int = 42, key: Column | None = None) -> DataFrame:
    """sized (with size and a struct row) and source_sizes, targets (arrays for the row's sources), taken: words the mix takes.

    sources: array of the sources that a row belongs to; rows that belong to the same ones form a
    pattern. Sources are ordered by code point, null last; weights go by that order and repeat
    (default 1, 2, 3). The driver holds a few numbers for each pattern, at most MOST_PATTERNS; a pattern
    of one source that no other pattern shares takes that source's target, and the flow runs on the
    others, at most MOST_FLOW. More of either raise an error, as no document is left out silently;
    rows are then drawn in a seeded order of `key`, whole documents only: all get the full copies,
    some one more, and two further passes fill what is left with documents that fit. Rows of size 0 take 0. Equal rows are drawn alike up to their place in
    the order, which also depends on nothing but the row. No row: no result.
    """
    scratch = Scratch(sized.sparkSession)
    weights = weights or [1.0, 2.0, 3.0]
    pattern = F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.struct(s.isNull().alias("none"), s.alias("name")))))
    draw = F.shiftrightunsigned(F.xxhash64(key if key is not None else F.to_json("row"), F.lit(seed)), 64 - BITS * LEVELS)
    rows = scratch.keep(sized.select("row", "size", pattern.alias("pattern"), F.xxhash64(pattern).alias("pid"), draw.alias("draw")), "rows")
    totals = rows.groupBy("pid", "pattern").agg(F.sum("size").alias("words")).limit(MOST_PATTERNS + 1).collect()
    if len(totals) > MOST_PATTERNS:
        raise ValueError(f"over {MOST_PATTERNS} membership patterns; group the sources first")
    if not totals:
        return rows.select("row", "size", F.array(F.lit(0).cast("long")).alias("source_sizes"), F.array(F.lit(0.0)).alias("targets"), F.lit(0).cast("long").alias("taken"))
    if len({r.pid for r in totals}) < len(totals):
        raise ValueError("two membership patterns share a hash; rename a source")
    totals.sort(key=lambda r: [(m.none, m.name or "") for m in r.pattern])
    names = sorted({(m.none, m.name or "") for r in totals for m in r.pattern})
    number = {n: i for i, n in enumerate(names)}
    members = [tuple(number[m.none, m.name or ""] for m in r.pattern) for r in totals]
    total = [r.words for r in totals]
    sizes = [0] * len(names)
    for m, words in zip(members, total, strict=True):
        for i in m:
            sizes[i] += words
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(names))])
    flow = _flow(members, total, [int(x) for x in targets])
    plan = []
    for r, m, use in zip(totals, members, flow, strict=True):
        words = sum(use.values())
        full = words // r.words if r.words else 0
        plan.append((r.pid, int(full), int(words - full * r.words), [int(sizes[i]) for i in m], [float(targets[i]) for i in m]))
    plan = sized.sparkSession.createDataFrame(plan, "pid long, full long, need long, source_sizes array<long>, targets array<double>").coalesce(1)
    # the seeded order first, then two rounds that fill what is left with documents that fit
    state = rows.select("pid", "draw", "size").where("size > 0")
    needs, cuts = plan.select("pid", "need"), []
    chosen = F.lit(False)
    placed = rows
    for turn in range(3):
        cut = _fill(state, needs, scratch, f"turn{turn}")
        cuts.append(cut.select("pid", F.col("below").alias(f"below{turn}"), F.col("need").alias(f"room{turn}")))
        needs = cut.select("pid", "need")
        if turn < 2:
            state = state.join(F.broadcast(cut.withColumnRenamed("need", "room")), "pid").where("draw >= below and size <= room").select("pid", "draw", "size")
    for turn, cut in enumerate(cuts):
        placed = placed.join(F.broadcast(cut), "pid", "left")
        fits = (F.col("draw") < F.col(f"below{turn}")) & (F.col("size") > 0)
        if turn:
            fits &= F.col("size") <= F.col(f"room{turn - 1}")
            fits &= ~chosen
        chosen = chosen | F.coalesce(fits, F.lit(False))
    placed = placed.join(F.broadcast(plan), "pid").withColumn("taken", F.col("size") * (F.col("full") + F.when(chosen, 1).otherwise(0)))
    return placed.select("row", "size", "source_sizes", "targets", "taken")
