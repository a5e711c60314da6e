"""Personal data: four fixed forms, and identifiers found by bootstrapped contexts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.llm._shared import Scratch, offsets

#: Kinds in the order in which spans at one place are listed.
KINDS = ("email", "ip", "card", "phone")
#: Base kinds, and one that only patterns add.
NAMES = (*KINDS, "secret")
#: The forms, with guards and possessive repeats that match the same but never try a run again from within.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A form is only looked for in texts that hold a match of this, which is found or ruled out faster.
_SIGN = {"email": "[A-Za-z0-9]@|[._%+-]@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": "[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_WS = r"\x20\x09-\x0D"
#: Words that hold a digit or @, from which identifiers are discovered.
CANDIDATE = rf"(?<![^{_WS}])[^{_WS}0-9@]*+[0-9@][^{_WS}]*+"
#: Seeds of the last kind: lower-case hexadecimal words of the usual lengths of keys, in quotes.
SECRET = "^(?=.*[a-f])(?=.*[0-9])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
#: Words in a row, one blank apart, that one identifier may have if they hold no letter.
MOST_PARTS = 3
#: Rounds of scoring on the graph of patterns and instances.
ROUNDS = 3
#: A pattern spreads to its instances from SPREAD on. It yields spans from a score on, with so many different seeds:
#: those of two words and a shape, and the general ones of a shape with one word or none.
SPREAD, SURE, GENERAL = 0.6, (0.85, 5), (0.95, 20)
#: Identifiers above this length are told by their length alone.
LONG = 64
_SCALE = 1_000_000


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, match, gap, after): all matches with their places in code points, the text since the last one and up to the next one."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)

    def placed(pairs: Column) -> Column:
        begin = offsets(F.transform(pairs, lambda x: F.length(x["gap"]) + F.length(x["match"])))
        one = lambda x, at: F.struct((at + F.length(x["gap"])).alias("start"), (at + F.length(x["gap"]) + F.length(x["match"])).alias("end"), x["match"], x["gap"], x["after"])
        return F.zip_with(pairs, begin, one)

    def both(x: Column) -> Column:
        return F.transform(x["found"], lambda m, i: F.struct(m.alias("match"), F.get(x["gaps"], i).alias("gap"), F.get(x["gaps"], i + 1).alias("after")))

    # arrays of one hold the matches and gaps, so that they are found once
    pairs = F.transform(F.array(F.struct(found.alias("found"), gaps.alias("gaps"))), both)
    return F.get(F.transform(pairs, placed), 0)


def _form(text: Column, k: int) -> Column:
    kind, none = KINDS[k], F.array().cast("array<struct<start:int,kind:int,end:int>>")
    valid = F.filter(_matches(text, FORMS[kind]), lambda m: _valid(kind, m["match"]))
    spans = F.transform(valid, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end")))
    return F.when(F.regexp_like(text, F.lit(_SIGN[kind])), spans).otherwise(none)


def _base(text: Column) -> Column:
    """All valid matches of the forms as (start, order of the kind, end), sorted."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    digits = [F.when(F.regexp_like(text, F.lit("[0-9]")), F.concat(*[_form(text, k) for k in range(1, len(KINDS))])).otherwise(none)]
    return F.array_sort(F.concat(F.when(F.contains(text, F.lit("@")), _form(text, 0)).otherwise(none), *digits))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.regexp_replace(text, "[0-9]", "0")), rf"[{_WS}]+"), lambda w: w != "")


def _candidates(text: Column) -> Column:
    """Words with a digit or @, and up to MOST_PARTS such words in a row without letters, without punctuation around them:
    place, text, whether in quotes, and the patterns in which they stand: (g, p), g: a general one."""
    found = _matches(text, CANDIDATE)
    kind = "array<struct<start:int,end:int,core:string,quoted:boolean,patterns:array<struct<g:boolean,p:string>>>>"

    def one(all_: Column, i: Column, k: int) -> Column:
        m, last = F.get(all_, i), F.get(all_, i + k - 1)
        whole = F.array_join(F.transform(F.slice(all_, i + 1, k), lambda x: x["match"]), " ")
        head = F.length(F.regexp_extract(whole, r"^[^\p{L}\p{N}+(]*+", 0))
        core = F.regexp_replace(F.substring(whole, head + 1, F.length(whole)), r"[^\p{L}\p{N})]++$", "")
        begin = m["start"] + head
        left = _words(F.concat(F.when(i > 0, F.get(all_, i - 1)["match"]).otherwise(""), m["gap"]))
        right = F.get(_words(F.concat(last["after"], F.when(i + k < F.size(all_), F.get(all_, i + k)["match"]).otherwise(""))), 0)
        shape = F.when(F.regexp_like(core, F.lit("^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_-]{16,}$")) | (F.length(core) > LONG), F.concat(F.lit("x"), F.length(core)))
        shape = F.coalesce(shape, F.regexp_replace(F.regexp_replace(core, "[0-9]", "9"), r"\p{L}++", "a"))
        near = F.coalesce(F.get(left, F.size(left) - 1), F.lit(""))
        patterns = F.array(
            F.struct(F.lit(False).alias("g"), F.concat_ws("\t", F.lit("2"), F.array_join(F.slice(left, F.greatest(F.size(left) - 1, F.lit(1)), F.lit(2)), " "), shape).alias("p")),
            F.struct(F.lit(True).alias("g"), F.concat_ws("\t", F.lit("1"), near, shape).alias("p")),
            F.struct(F.lit(True).alias("g"), F.concat_ws("\t", F.lit("r"), F.coalesce(right, F.lit("")), shape).alias("p")),
            F.struct(F.lit(True).alias("g"), F.concat_ws("\t", F.lit("0"), shape).alias("p")),
        )
        quoted = (F.substring(whole, head, F.lit(1)) == '"') & (F.substring(whole, head + F.length(core) + 1, F.lit(1)) == '"')
        return F.struct(begin.alias("start"), (begin + F.length(core)).alias("end"), core.alias("core"), (quoted & (head > 0)).alias("quoted"), patterns.alias("patterns"))

    def starts(all_: Column, k: int) -> Column:
        """Places of k words in a row, of more than one only without letters."""
        index = F.sequence(F.lit(0), F.size(all_) - k)
        if k == 1:
            return index
        part = lambda x: ~F.regexp_like(x["match"], F.lit(r"[\p{L}@]"))
        return F.filter(index, lambda i: F.forall(F.slice(all_, i + 1, k), part) & F.forall(F.slice(all_, i + 2, k - 1), lambda x: x["gap"] == " "))

    def all_of(all_: Column) -> Column:
        def of(k: int) -> Column:
            return F.when(F.size(all_) >= k, F.transform(starts(all_, k), lambda i: one(all_, i, k))).otherwise(F.array().cast(kind))

        return F.concat(*map(of, range(1, MOST_PARTS + 1)))

    # the outer array holds the matches, so that they are found once, not again for each word
    words = F.get(F.transform(F.array(found), all_of), 0)
    return F.when(F.regexp_like(text, F.lit("[0-9@]")), words).otherwise(F.array().cast(kind))


def _discover(places: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, row, found): spans that high-confidence patterns add, from places(doc, row, base, start, end, core, quoted, patterns).

    Nodes are patterns (two words before and the shape; and more general: one word before or behind
    and the shape, the shape alone) and instances (the text). An instance that is a base span is a seed
    of that kind, one of the form SECRET in quotes one of the last kind. In each round a pattern's
    score for a kind is the mean score of its occurrences, counted with one more of score 0; an
    instance's is the noisy-or over its patterns from SPREAD on. All scores are whole millionths, so
    reruns agree. Words that overlap a base span without being one are left out."""
    same = F.filter("base", lambda b: (b["start"] == F.col("start")) & (F.col("end") == b["end"]))
    apart = F.forall("base", lambda b: (b["end"] <= F.col("start")) | (F.col("end") <= b["start"]))
    places = places.where("core <> ''").withColumns({"seed": F.get(same, F.lit(0))["kind"], "apart": apart}).where("apart or seed is not null")
    secret = F.col("apart") & F.col("quoted") & F.regexp_like("core", F.lit(SECRET))
    places = places.withColumns({"seed": F.when(secret, len(KINDS)).otherwise(F.col("seed")), "core": F.lower("core")}).drop("base", "quoted")
    places = scratch.keep(places, "places")
    seeds = places.where("seed is not null").select("core", F.col("seed").alias("kind")).distinct()
    edges = places.select("core", F.explode("patterns").alias("x")).groupBy("x.g", F.col("x.p").alias("pattern"), "core").agg(F.count("*").alias("n"))
    edges = scratch.keep(edges, "edges")
    sizes = scratch.keep(edges.groupBy("pattern").agg(F.sum("n").alias("all")), "sizes")
    score = seeds.withColumn("score", F.lit(_SCALE).cast("long"))
    for k in range(ROUNDS):
        patterns = edges.join(score, "core").groupBy("g", "pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("sum"), F.count_if(F.col("score") == _SCALE).alias("seeds"), F.sum(F.when(F.col("score") == _SCALE, F.col("n")).otherwise(0)).alias("own"))
        patterns = patterns.join(sizes, "pattern").select("g", "pattern", "kind", "seeds", F.floor(F.col("own") * _SCALE / (F.col("all") + 1)).cast("long").alias("own"), F.floor(F.col("sum") / (F.col("all") + 1)).cast("long").alias("score"))
        patterns = scratch.keep(patterns, f"patterns-{k}")
        if k == ROUNDS - 1:
            break
        miss = F.floor(F.log(1 - F.col("score") / (_SCALE + 1)) * _SCALE).cast("long")
        reached = edges.join(patterns.where(F.col("score") >= int(SPREAD * _SCALE)).select("pattern", "kind", "score"), "pattern")
        reached = reached.groupBy("core", "kind").agg(F.sum(miss).alias("miss")).select("core", "kind", F.floor((1 - F.exp(F.col("miss") / _SCALE)) * (_SCALE - 1)).cast("long").alias("score"))
        score = scratch.keep(score.where(F.col("score") == _SCALE).union(reached).groupBy("core", "kind").agg(F.max("score").alias("score")), f"score-{k}")
    # a general pattern is judged by its seeds alone, as instances that others reached are too easy to come by for it
    sure = [(F.col("g") == g) & (F.col(by) >= int(least * _SCALE)) & (F.col("seeds") >= seeds_) for g, by, (least, seeds_) in ((False, "score", SURE), (True, "own", GENERAL))]
    sure = patterns.where(sure[0] | sure[1]).groupBy("pattern").agg(F.max(F.struct("score", (-F.col("kind")).alias("first"))).alias("best"))
    found = places.where("apart").select("doc", "row", "start", "end", F.explode("patterns").alias("x")).select("doc", "row", "start", "end", F.col("x.p").alias("pattern"))
    found = found.join(sure.select("pattern", "best.score", (-F.col("best.first")).alias("kind")), "pattern")
    # one kind for each place: that of its surest pattern
    best = found.groupBy("doc", "row", "start", "end").agg((-F.max(F.struct("score", (-F.col("kind")).alias("first")))["first"]).alias("kind"))
    return best.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("found"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, base, spans) of every row: row is a struct of the columns but the text, the others arrays of
    (start, kind, end) by start, then kind (an index of KINDS), in code points, end exclusive.

    base: matches of the forms that pass their checks (Luhn, parts to 255, number of digits), leftmost
    and without overlap for each kind. spans: base and what patterns add (`_discover`): words that
    never overlap a base span, in patterns in which nearly all words are base spans of one kind or
    seeds of the kind secret (the last of NAMES). Null and empty texts have none. Equal rows, and rows with one id and equal texts, have
    equal spans; a null id is an id like others. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]) if len(docs.columns) > 1 else F.struct(F.lit(None).alias("none"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(others.alias("columns"), F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("row"), _base(text).alias("base"), _candidates(text).alias("words"))
    rows = scratch.keep(rows, "rows")  # without texts
    words = rows.select("doc", "row", "base", F.explode("words").alias("w")).select("doc", "row", "base", "w.*").dropDuplicates(["doc", "row", "start", "end"])
    more = _discover(words, scratch)
    out = rows.select("columns", F.col("doc").alias("d"), F.col("row").alias("r"), "base").join(more, F.col("d").eqNullSafe(F.col("doc")) & (F.col("r") == F.col("row")), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("found", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    return out.select(F.col("columns").alias("row"), "base", spans.alias("spans"))


def count(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
