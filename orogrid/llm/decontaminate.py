"""Benchmark decontamination by spaced seeds, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.llm._shared import Scratch

#: The masks. A seed looks at the words marked 1 only, so a changed word under a 0 doesn't hide it.
MASKS = ("11101001111", "11011110011", "11110010111")
SPAN = 11
#: Words on either side of a hit over which the overlap is verified.
AROUND = 48
#: An overlap counts if its words that agree, less PENALTY for each one that differs, come to this (or to all words of a shorter item).
LEAST_SCORE, PENALTY = 12, 2
#: Seeds of one block of test items (under 100 bytes each in memory on an executor); more items make more blocks.
BLOCK_SEEDS = 1_000_000


def words(text: Column) -> Column:
    """Lower-case words of a text; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _seeds(hashes: str, at: Column) -> Column:
    """The seeds of the SPAN words from `at` on, one for each mask."""
    return F.array(*[F.xxhash64(F.lit(k), *[F.col(hashes)[at + j] for j, bit in enumerate(mask) if bit == "1"]) for k, mask in enumerate(MASKS)])


def _positions(df: DataFrame, hashes: str) -> DataFrame:
    """A row for each word from which SPAN words follow. Spark runs this and the seeds in one compiled loop; no array is copied."""
    return df.where(F.size(hashes) >= SPAN).select("*", F.explode(F.sequence(F.lit(0), F.size(hashes) - SPAN)).alias("i"))


def _score() -> Column:
    """The best run of the aligned words around a hit: agreeing words, less PENALTY for each other one."""
    low = F.greatest(-F.col("i0"), -F.col("j"), F.lit(-AROUND))
    high = F.least(F.size("near") - F.col("i0"), F.size("item_hashes") - F.col("j"), F.lit(SPAN + AROUND)) - 1
    step = lambda t: F.when(F.col("near")[F.col("i0") + t] == F.col("item_hashes")[F.col("j") + t], 1).otherwise(-PENALTY)
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def go(a: Column, t: Column) -> Column:
        run = F.greatest(F.lit(0), a["run"] + step(t))
        return F.struct(run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(F.sequence(low, high), start, go)["best"]


def _short(data: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(doc, row, item, score, i, last) where a document holds all words of an item of fewer than SPAN in a row; None without such items.

    The words of each length that items have are hashed at every position and meet broadcast blocks like seeds."""
    items = scratch.keep(items.select("item", "item_hashes", F.size("item_hashes").alias("n"), F.xxhash64("item_hashes").alias("seed")), "short")
    lengths = {r.n: r["count"] for r in items.groupBy("n").count().collect()}
    found = None
    for n in sorted(lengths):
        blocks = -(-lengths[n] // BLOCK_SEEDS)
        for b in range(blocks):
            block = items.where((F.col("n") == n) & (F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)).select("item", "item_hashes", "seed")
            at = data.where(F.size("hashes") >= n).select("doc", "row", "hashes", F.explode(F.sequence(F.lit(0), F.size("hashes") - n)).alias("i"))
            at = at.select("doc", "row", "i", F.array(*[F.col("hashes")[F.col("i") + k] for k in range(n)]).alias("held")).withColumn("seed", F.xxhash64("held"))
            hits = at.join(F.broadcast(block), "seed").where(F.col("held") == F.col("item_hashes")).select("doc", "row", "item", F.lit(n).alias("score"), "i", (F.col("i") + n - 1).alias("last"))
            found = hits if found is None else found.union(hits)
    return found


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc, row, item, score, first, last): test items that a document holds, row by row.

    first and last: the words of the document at which the first verified seed begins and the last
    one ends. Positions of all documents are hashed in place and meet a broadcast block of seeds of
    at most BLOCK_SEEDS; only hits leave the scan, each with the words around it.
    """
    scratch = Scratch(docs.sparkSession)
    hashed = items.select(F.col(item_col).alias("item"), F.transform(words(F.col(item_text_col).cast("string")), lambda w: F.xxhash64(w)).alias("item_hashes")).where(F.size("item_hashes") > 0)
    short = hashed.where(F.size("item_hashes") < SPAN)
    hashed = scratch.keep(hashed.where(F.size("item_hashes") >= SPAN), "items")
    count = hashed.agg(F.sum((F.size("item_hashes") - SPAN + 1) * len(MASKS))).first()[0] or 0
    blocks = max(1, -(-count // BLOCK_SEEDS))
    data = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("row"), F.transform(words(F.col(text_col).cast("string")), lambda w: F.xxhash64(w)).alias("hashes"))
    found = None
    for b in range(blocks):
        # blocks are dealt by seed, so that one very long item does not exceed a block
        seeds = _positions(hashed, "item_hashes").select("item", F.col("i").alias("j"), F.explode(_seeds("item_hashes", F.col("i"))).alias("seed")).where(F.pmod("seed", F.lit(blocks)) == b)
        hits = _positions(data, "hashes").select("doc", "row", "hashes", "i", F.explode(_seeds("hashes", F.col("i"))).alias("seed")).join(F.broadcast(seeds), "seed")
        near = F.slice("hashes", F.greatest(F.col("i") - AROUND, F.lit(0)) + 1, F.lit(2 * AROUND + SPAN))
        hits = hits.select("doc", "row", "item", "i", "j", near.alias("near"), F.least(F.col("i"), F.lit(AROUND)).alias("i0"))
        hits = scratch.keep(hits, f"hits-{b}")
        scored = hits.join(hashed, "item").withColumn("score", _score()).where(F.col("score") >= F.least(F.lit(LEAST_SCORE), F.size("item_hashes"))).select("doc", "row", "item", "score", "i", (F.col("i") + SPAN - 1).alias("last"))
        found = scored if found is None else found.union(scored)
    whole = _short(data, short, scratch)
    found = found if whole is None else found.union(whole)
    return found.groupBy("doc", "row", "item").agg(F.max("score").alias("score"), F.min("i").alias("first"), F.max("last").alias("last"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names: str) -> DataFrame:
    """(row, contaminated, items, score) of every row of docs; row is a struct of all its columns.

    items: the ids of the test items found, in order; score: the best overlap (0: none). An overlap
    is a run of aligned words of a document and an item with a seed in it in which agreeing words,
    less PENALTY for each that differs, come to LEAST_SCORE: 12 equal words, or 13 to 16 with one replaced.
    Null and empty texts hold no item. Items with
    fewer than SPAN words are found where all their words stand in a row (score: their number). Rows with
    a null id are judged as well; equal rows stay as many. Empty tables on either side give no overlap.
    """
    found = overlaps(docs, items, id_col, text_col, **names).groupBy("doc", "row").agg(F.array_sort(F.collect_list("item")).alias("items"), F.max("score").alias("score"))
    data = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(id_col).alias("doc_key"), F.xxhash64(text_col).alias("row_key"))
    out = data.join(found, F.col("doc_key").eqNullSafe(F.col("doc")) & (F.col("row_key") == F.col("row")), "left")
    none = F.array().cast(found.schema["items"].dataType)
    return out.select(F.col("whole").alias("row"), F.col("score").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"), F.coalesce("score", F.lit(0)).alias("score"))
