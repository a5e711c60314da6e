"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orogrid.llm._shared import Scratch

#: Lines with fewer words are always kept unless the caller asks for less: the SQL of the query has this floor.
LEAST_WORDS = 3
#: Lines with fewer words are compared exactly only: one edit would be too large a share of them.
EDIT_WORDS = 8


def _plain(line: Column) -> Column:
    """The words of a line with one space between; the line itself if it looks so already, without a regular expression."""
    odd = F.contains(line, F.lit("  "))
    for c in "\t\x0b\x0c\r":
        odd |= F.contains(line, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))


def _count(plain: Column) -> Column:
    return F.when(plain == "", 0).otherwise(F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit(""))) + 1)


def _lines(docs: DataFrame, least_words: int) -> DataFrame:
    """(place, plain, n, line) of every line of at least least_words words; place orders all lines of the corpus."""
    rows = docs.select("doc", "row", F.posexplode(F.split("text", "\n", -1)).alias("at", "text"))
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "row", "at").alias("place")
    rows = rows.select(place, _plain(F.col("text")).alias("plain")).withColumn("n", _count(F.col("plain")))
    return rows.where(F.col("n") >= least_words).withColumn("line", F.xxhash64("plain"))


def _halves() -> list[Column]:
    """Keys of which any two lines within one edit of each other share one at least.

    Of two lines with m words, or m and m + 1, the edit leaves one half whole: either the first m/2
    words of both are the same or what follows them (in the longer line, from one word later)."""

    def keys(m: Column, skip: int) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        return [
            F.xxhash64(m, F.lit(0), F.call_function("substring_index", F.col("plain"), F.lit(" "), half)),
            F.xxhash64(m, F.lit(1), F.call_function("substring_index", F.col("plain"), F.lit(" "), half + skip - F.col("n"))),
        ]

    return [*keys(F.col("n"), 0), *keys(F.col("n") - 1, 1)]


def _within_one_edit(a: Column, b: Column) -> Column:
    """True if word arrays a and b are equal or one inserted, deleted or replaced word apart."""
    least, most = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    index = F.sequence(F.lit(0), least - 1)
    head = F.coalesce(F.get(F.filter(index, lambda i: F.get(a, i) != F.get(b, i)), 0), least)
    tail = F.coalesce(F.get(F.filter(index, lambda i: F.get(a, F.size(a) - 1 - i) != F.get(b, F.size(b) - 1 - i)), 0), least)
    return (most - least <= 1) & (head + tail >= most - 1)


def _near(docs: DataFrame, unique: DataFrame, scratch: Scratch) -> DataFrame:
    """(line, near): the earliest place of another line within one edit, for lines that have one."""
    keyed = unique.where(F.col("n") >= EDIT_WORDS).select("line", F.explode("halves").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("line").alias("least"), F.max("line").alias("most")).where("least < most").select("key")
    some = keyed.join(scratch.keep(shared, "shared"), "key").select("line").distinct()
    # the texts of these lines, from the documents in which they stand first
    first = unique.join(some, "line").select("line", F.col("place.doc").alias("doc"), F.col("place.row").alias("row"), F.struct(F.col("place.at").alias("at"), "line").alias("x"))
    first = scratch.keep(first.groupBy("doc", "row").agg(F.collect_list("x").alias("xs")), "first")
    held = docs.alias("d").join(first.hint("merge").alias("f"), F.col("d.doc").eqNullSafe(F.col("f.doc")) & (F.col("d.row") == F.col("f.row"))).select("d.doc", "d.row", F.split("text", "\n", -1).alias("lines"), "xs")
    held = held.select("doc", "row", F.explode(F.transform("xs", lambda x: F.struct(x["line"].alias("line"), x["at"].alias("at"), F.get("lines", x["at"]).alias("text")))).alias("x"))
    texts = held.select("x.line", F.split(_plain(F.col("x.text")), " ").alias("words"), F.struct(F.col("doc").isNull().alias("none"), "doc", "row", "x.at").alias("place"))
    texts = scratch.keep(texts.dropDuplicates(["line"]), "lines")  # equal rows of docs give the same line again
    scratch.drop("shared", "first")
    # deletion variants: with the word hashes of a line tied to their places, a variant is the xor of
    # what stands before the deleted word and of what stands after it, one place earlier
    word = texts.select("line", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    word = word.select("line", "n", "i", F.xxhash64("word", "i").alias("here"), F.xxhash64("word", F.col("i") - 1).alias("there"))
    to_here = Window.partitionBy("line").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    all_words = Window.partitionBy("line")
    before = F.bit_xor("here").over(to_here).bitwiseXOR(F.col("here"))
    after = F.bit_xor("there").over(all_words).bitwiseXOR(F.bit_xor("there").over(to_here))
    variants = word.select("line", "n", "i", before.bitwiseXOR(after).alias("key"), F.bit_xor("here").over(all_words).alias("whole"))
    variants = scratch.keep(variants.join(texts.select("line", "place"), "line"), "variants")
    # replaced word: both lines lose the word at the same place. All lines of such a group are one edit
    # apart, so each is held against the earliest only
    groups = variants.groupBy("key", "i", "n").agg(F.min(F.struct("place", "line")).alias("lead"), F.count("*").alias("m")).where("m > 1")
    swapped = variants.join(groups, ["key", "i", "n"]).where(F.col("line") != F.col("lead.line")).select("line", F.col("lead.line").alias("other"))
    # inserted word: the longer line loses it and equals the shorter one
    whole = variants.where("i = 0").select(F.col("whole").alias("key"), (F.col("n") + 1).alias("n"), F.col("line").alias("short"))
    longer = variants.join(whole, ["key", "n"]).select("line", "short")
    pairs = swapped.union(longer.select("line", F.col("short").alias("other"))).union(longer.select(F.col("short").alias("line"), F.col("line").alias("other"))).distinct()
    pairs = pairs.join(texts.select("line", "words"), "line").join(texts.select(F.col("line").alias("other"), F.col("words").alias("others"), F.col("place").alias("near")), "other")
    return pairs.where(_within_one_edit(F.col("words"), F.col("others"))).groupBy("line").agg(F.min("near").alias("near"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(row, text, n_lines, n_dropped, n_near, n_left) of every row of docs; row is a struct of its columns but the text.

    A line (between \\n) of least_words words or more is dropped if an earlier line has the same words,
    or, from EDIT_WORDS words on, if an earlier line is one inserted, deleted or replaced word away
    (n_near counts those without an equal one before; n_left the lines of least_words words that stay). Earlier: in a document with a smaller id, or
    before it in the same one; null ids come last. All lines are judged on the input, so a line can
    fall to one that itself falls. White space between words does not count; kept lines stay as they
    are and are joined by \\n again. A null text stays null (no lines); an empty one has one line.

    Lines are named by a 64-bit hash of their words. Only lines that share one of their halves with
    another line emit their deletion variants (an exact filter). Groups of variants are linked to
    their earliest line, not pairwise, so that thousands of variants of one line make as many links.
    Every near link is verified on the words. Rows with equal id and text count as one and keep the
    same lines; rows with one id and different texts are ordered by a hash of the text.
    """
    scratch = Scratch(docs.sparkSession)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]) if len(docs.columns) > 1 else F.struct(F.lit(None).alias("none"))
    docs = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("row"), F.col(text_col).cast("string").alias("text"), others.alias("columns"))
    place = ("none", "doc", "row", "at")
    found = _lines(docs.select("doc", "row", "text"), least_words)
    halves = [F.when(F.col("n") >= EDIT_WORDS, h).alias(f"h{k}") for k, h in enumerate(_halves())]
    # flat numbers are combined on the map side; the halves are equal for equal lines
    flat = found.select("line", "n", *(F.col(f"place.{c}").alias(c) for c in place), *halves)
    unique = flat.groupBy("line", "n").agg(F.min(F.struct(*place)).alias("place"), *(F.min(f"h{k}").alias(f"h{k}") for k in range(4)))
    unique = scratch.keep(unique.select("line", "n", "place", F.array("h0", "h1", "h2", "h3").alias("halves")), "unique")
    near = _near(docs.select("doc", "row", "text"), unique, scratch)
    fell = F.col("near").isNotNull() & (F.col("near") < F.col("place"))
    told = unique.select("line", "place").join(near, "line", "left").select(*(F.col(f"place.{c}").alias(c) for c in place), fell.alias("fell"))
    told = told.groupBy("none", "doc", "row").agg(F.collect_list(F.when(~F.col("fell"), F.col("at"))).alias("firsts"), F.count_if("fell").alias("n_near"))
    told = scratch.keep(told, "told")
    scratch.drop("unique", "lines", "variants")
    out = docs.withColumn("none", F.col("doc").isNull()).alias("d").join(
        told.hint("merge").alias("t"), F.col("d.doc").eqNullSafe(F.col("t.doc")) & (F.col("d.row") == F.col("t.row")), "left"
    )
    lines = F.split("text", "\n", -1)

    def kept(all_: Column) -> Column:
        """The lines that stay, by hashed operations on line numbers. Words are counted only in lines that are not known to stay."""
        numbers = F.transform(all_, lambda x, i: i)
        words = lambda x: F.get(F.transform(F.array(_plain(x)), _count), 0)  # noqa: E731  (an array of one: no word is sought twice)
        short = F.filter(F.array_except(numbers, F.col("firsts")), lambda i: words(F.get(all_, i)) < least_words)
        return F.transform(F.array_intersect(numbers, F.concat("firsts", short)), lambda i: F.get(all_, i))

    out = out.select("columns", F.col("d.text").alias("text"), F.coalesce("firsts", F.array().cast("array<int>")).alias("firsts"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))
    # an array of one holds the lines, so that the text is split once
    out = out.withColumn("kept", F.get(F.transform(F.array(lines), kept), 0)).withColumn("n", F.coalesce(F.size(lines), F.lit(0)))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_kept = F.when(F.col("text").isNull(), 0).otherwise(F.size("kept")).cast("long")
    return out.select(F.col("columns").alias("row"), F.array_join("kept", "\n").alias("text"), n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"), "n_near", F.coalesce(F.size("firsts"), F.lit(0)).cast("long").alias("n_left"))
