"""URL filter: rules by host and path, and a ratio of character language models for what they leave open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.llm._shared import Scratch

#: Characters before the next one that the models look at, at most.
ORDER = 5
#: Every FOLDS-th distinct judged address is held out from the counts and sets the threshold.
FOLDS = 5
#: Log-likelihood differences are kept as whole millionths, so that sums do not depend on their order.
SCALE = 1_000_000
#: Score bins of the calibration, one for each hundredth of a nat a character, from -CLAMP to CLAMP.
CLAMP = 10
#: Characters outside printable ASCII are one symbol: tables of orders 0 and 1 have under 10,000 rows, whatever the data.
_OTHER = "\u0001"
_START = "\u0002"
#: What rules need to be judged.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ://."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def apply_rules(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. rules: texts host/path-prefix with verdicts."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + start))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(df: DataFrame, length: Column) -> DataFrame:
    """df with a row for each character of `address`: gram is that character after the ORDER ones before it."""
    padded = df.withColumn("padded", F.concat(F.lit(_START * ORDER), F.regexp_replace("address", r"[^\x21-\x7e]", _OTHER)))
    at = padded.where(length > 0).select("*", F.explode(F.sequence(F.lit(1), length)).alias("at"))
    return at.withColumn("gram", F.substring(F.col("padded"), F.col("at"), F.lit(ORDER + 1))).drop("padded", "at")


def train(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, ratio): for every gram of ORDER + 1 characters, the log of its last character's probability in the
    accepted model over that in the rejected one, in whole 1 / SCALE.

    counts: (gram, good, bad) with all grams to be scored (0 where not counted). Witten-Bell smoothing
    from the uniform distribution over order 0, 1, ... up to ORDER: with n followers of a context, of
    which t are distinct, p = (count + t * p_below) / (n + t); a context never seen passes p_below on.
    Each order joins the one below on a suffix that at most as many grams share as there are characters.
    """
    below = None
    for k in range(ORDER + 1):
        grams = counts.groupBy(F.substring("gram", ORDER + 1 - k, k + 1).alias("g")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        grams = grams.withColumn("context", F.substring("g", 1, k))
        seen = [F.sum(c).alias(f"{c}_n") for c in ("good", "bad")] + [F.count_if(F.col(c) > 0).alias(f"{c}_t") for c in ("good", "bad")]
        context = grams.groupBy("context").agg(*seen)
        small = F.broadcast if k < 2 else (lambda df: df)  # under 10,000 rows, see _OTHER
        table = grams.join(small(context), "context")
        if below is None:
            table = table.withColumn("good_p", F.lit(1 / 97)).withColumn("bad_p", F.lit(1 / 97))
        else:
            table = table.withColumn("suffix", F.substring("g", 2, k)).join((F.broadcast if k < 3 else lambda df: df)(below), "suffix")
        p = [F.when(F.col(f"{c}_t") == 0, F.col(f"{c}_p")).otherwise((F.col(c) + F.col(f"{c}_t") * F.col(f"{c}_p")) / (F.col(f"{c}_n") + F.col(f"{c}_t"))).alias(f"{c}_p") for c in ("good", "bad")]
        below = scratch.keep(table.select(F.col("g").alias("suffix"), *p), f"order-{k}")
    return below.select(F.col("suffix").alias("gram"), F.round(F.log(F.col("good_p") / F.col("bad_p")) * SCALE).cast("long").alias("ratio"))


def calibrate(scores: DataFrame) -> tuple[float, float]:
    """Threshold and its balanced accuracy on held-out scores (score, good): the least bin from which accepting
    gives the best mean of the two hit rates. Reads a few thousand bin counts; no held-out row of a class: 0."""
    bins = F.floor(F.greatest(F.least(F.col("score"), F.lit(float(CLAMP))), F.lit(float(-CLAMP))) * 100).cast("long")
    rows = sorted(scores.groupBy(bins.alias("bin")).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).collect())
    good, bad = sum(r.good for r in rows), sum(r.bad for r in rows)
    if not good or not bad:
        return 0.0, 0.0
    best, at, passed, stopped = 0.5, rows[0].bin, good, 0
    for r in rows:
        if (passed / good + stopped / bad) / 2 > best:
            best, at = (passed / good + stopped / bad) / 2, r.bin
        passed, stopped = passed - r.good, stopped + r.bad
    return at / 100, best


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, url_col: str = "url") -> DataFrame:
    """(row, host, path, rule, score, verdict) of every row; row is a struct of all columns of pages.

    The longest rule that fits gives the verdict. Other rows are judged by score: the log-likelihood
    difference for each character of host and path between a model of the addresses that rules allow
    and one of those they block, at or above a threshold set on held-out judged addresses: allow.
    Counts cover all judged rows (repeated ones count again); a row for each distinct address is
    scored once. Addresses without characters score 0. If rules judge no row of a class, the models
    are as good as equal and the threshold is 0, so everything open is allowed. Null URLs have empty
    host and path. Equal rows stay as many; an empty table gives an empty one.
    """
    scratch = Scratch(pages.sparkSession)
    host, path = split_url(F.col(url_col).cast("string"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host.alias("host"), path.alias("path"))
    rows = rows.select("row", "host", "path", apply_rules(F.col("host"), F.col("path"), rules).alias("by"), F.concat("host", "path").alias("address"))
    judged = F.when(F.col("by").isNotNull(), F.col("by.verdict") == "allow")
    kinds = rows.groupBy("address").agg(F.count("*").alias("times"), F.first(judged).alias("good"))  # the rules see nothing but the address's host and path
    kinds = scratch.keep(kinds.withColumn("held", F.pmod(F.xxhash64("address"), F.lit(FOLDS)) == 0), "addresses")
    length = F.length("address")
    grams = _grams(kinds, length)
    use = F.col("good").isNotNull() & ~F.col("held")
    counts = grams.groupBy("gram").agg(F.sum(F.when(use & F.col("good"), F.col("times")).otherwise(0)).alias("good"), F.sum(F.when(use & ~F.col("good"), F.col("times")).otherwise(0)).alias("bad"))
    model = train(scratch.keep(counts, "counts"), scratch)
    # held-out addresses for the threshold, and those that no rule judges
    wanted = grams.where("good is null or held").select("address", "gram").join(scratch.keep(model, "model"), "gram")
    total = wanted.groupBy("address").agg((F.sum("ratio") / F.count("*") / SCALE).alias("score"))
    total = scratch.keep(total, "scores")
    held = kinds.where("held and good is not null").join(total, "address").select("score", "good")
    threshold, _ = calibrate(held)
    out = rows.join(total, "address", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    verdict = F.coalesce(F.col("by.verdict"), F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return out.select("row", "host", "path", F.col("by.rule").alias("rule"), F.when(F.col("by").isNull(), F.col("score")).alias("score"), verdict.alias("verdict"))
