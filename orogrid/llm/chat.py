"""Chat formatting in DataFrame functions only: sorted turns, merged roles, reversible escapes, a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.llm._shared import offsets

#: What marks the turns of each role in the formatted text. Other roles: <<=role>> and <</=>>.
OPEN = {"user": "[INST]", "assistant": "<s>", "system": "<<SYS>>"}
CLOSE = {"user": "[/INST]", "assistant": "</s>", "system": "<</SYS>>"}
#: Between two turns of one role that stand together.
JOIN = "<+>"
#: No `<` or `[` of a text is left in the formatted text, so none of its control strings is either.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), (">", "&gt;"))
#: The role whose texts are trained on.
TRAINED = "assistant"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _mark(role: Column, marks: dict[str, str], other: Column) -> Column:
    out = other
    for name, mark in marks.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, mask) for every conversation.

    Turns are ordered by turn (nulls first), equal ones by role and text; repeated rows stay. Turns of
    one role that follow each other are merged into one marked block, with JOIN between their texts.
    A null role is the role "", a null text empty. mask: an array of (start, length) in code points of the formatted text,
    one for each text of the trained role, without marks. Rows with a null conv_id form one
    conversation. An empty table gives an empty one. One conversation is one row, so it must fit in
    memory, as its formatted text must.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chats = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # merge: the turns at which a role begins, then the texts from each to the next
    begins = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    chats = chats.withColumn("begins", begins)
    ends = F.concat(F.slice("begins", F.lit(2), F.size("begins")), F.array(F.size("turns")))
    blocks = F.transform(
        F.arrays_zip(F.col("begins").alias("a"), ends.alias("b")),
        lambda x: F.struct(F.get("turns", x["a"])["role"].alias("role"), F.transform(F.slice("turns", x["a"] + 1, x["b"] - x["a"]), lambda t: escape(t["text"])).alias("texts")),
    )

    def head(b: Column) -> Column:
        return _mark(b["role"], OPEN, F.concat(F.lit("<<="), escape(b["role"]), F.lit(">>")))

    def tail(b: Column) -> Column:
        return _mark(b["role"], CLOSE, F.lit("<</=>>"))

    chats = chats.withColumn("blocks", blocks)
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], JOIN), tail(b))), "")
    # where each text begins: lengths of all that stands before it
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t, k: F.struct((F.when(k == 0, F.length(head(b))).otherwise(len(JOIN))).alias("before"), F.length(t).alias("length"), (F.when(k == F.size(b["texts"]) - 1, F.length(tail(b))).otherwise(0)).alias("after"), (b["role"] == TRAINED).alias("trained")))))
    chats = chats.select("conv_id", formatted.alias("formatted"), pieces.alias("pieces"))
    chats = chats.withColumn("at", offsets(F.transform("pieces", lambda p: p["before"] + p["length"] + p["after"])))
    spans = F.zip_with("pieces", "at", lambda p, at: F.struct(p["trained"].alias("trained"), (at + p["before"]).alias("start"), p["length"].alias("length")))
    spans = F.transform(F.filter(spans, lambda x: x["trained"]), lambda x: F.struct(x["start"], x["length"]))
    return chats.select("conv_id", "formatted", spans.alias("mask"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss): the turns (role, text) and the unescaped text under the mask, from the formatted text alone."""
    blocks = F.filter(F.split("formatted", r"(?=\[INST\]|<s>|<<SYS>>|<<=)", -1), lambda b: b != "")

    def role(b: Column) -> Column:
        out = unescape(F.regexp_extract(b, "^<<=([^<>]*)>>", 1))
        for name, mark in OPEN.items():
            out = F.when(F.startswith(b, F.lit(mark)), F.lit(name)).otherwise(out)
        return out

    body = lambda b: F.regexp_replace(b, r"(?s)^(?:\[INST\]|<s>|<<SYS>>|<<=[^<>]*>>)|(?:\[/INST\]|</s>|<</SYS>>|<</=>>)\z", "")
    texts = F.flatten(F.transform(blocks, lambda b: F.transform(F.split(body(b), r"<\+>", -1), lambda t: F.struct(role(b).alias("role"), unescape(t).alias("text")))))
    loss = F.array_join(F.transform("mask", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["length"]))), "")
    return formatted.select("conv_id", texts.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
