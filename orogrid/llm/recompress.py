"""Substring deduplication by recompression: every window of consecutive words that an earlier document has."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orogrid.llm import _words as W
from orogrid.llm._shared import Scratch

#: Rounds after which symbols stand for long passages (about 30 words).
ROUNDS = 12
#: Symbols of the lowest levels that name a phrase, by level: of level 1 if a window holds so many whole ones, else words.
PHRASES = {1: 4, 0: 5}


class Symbols(NamedTuple):
    """Symbols of some texts laid end to end: names, the word at which each begins, and the words low to high on which
    its name and its place depend. low or high lie outside the text where its edge has a say."""

    names: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


def recompress(words: np.ndarray, first: np.ndarray, rounds: int) -> Symbols:
    """Symbols after some rounds. words: their hashes; first: where each text begins, and the end.

    A round names runs of one symbol and then the pairs of neighbours of which the left one falls in
    one half of the alphabet and the right one in the other. A name is a hash of what it replaces, so
    all tasks name alike without a table. Equal passages get equal symbols except at their edges: two
    places at which the words from low to high are the same have the same symbol between them.
    """
    n = len(words)
    opens = np.zeros(n + 1, bool)  # a text begins at this word
    opens[first] = True
    s, at, low, high = words, np.arange(n), np.arange(n), np.arange(n) + 1
    with np.errstate(over="ignore"):
        for r in range(rounds if n else 0):
            salt = np.uint64((2 * r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            # runs: where one ends is seen at its neighbours
            head = opens[at]
            head[1:] |= s[1:] != s[:-1]
            b = np.flatnonzero(head)
            e = np.append(b[1:], len(s)) - 1
            begins, ends = opens[at[b]], opens[np.append(at[b][1:], n)]
            run = (e - b + 1).astype(np.uint64)
            low = np.where(begins, at[b] - 1, low[np.maximum(b - 1, 0)])
            high = np.where(ends, np.append(at[b][1:], n) + 1, high[np.minimum(e + 1, len(s) - 1)])
            s, at = np.where(run > 1, W.mix(s[b] + run * salt), s[b]), at[b]
            # pairs: a left half needs its right neighbour to stay alone, a right half its left one
            left = (W.mix(s ^ salt) & np.uint64(1)).astype(bool)
            joined = np.zeros(len(s), bool)
            joined[:-1] = left[:-1] & ~left[1:] & ~begins[1:]
            taken = np.roll(joined, 1)
            taken[0] = False
            before, after = np.where(begins, at - 1, np.roll(low, 1)), np.where(ends, np.append(at[1:], n) + 1, np.roll(high, -1))
            low, high = np.where(left | taken, low, before), np.where(left, after, high)
            s = np.where(joined, W.mix(s * np.uint64(0xD1342543DE82EF95) + W.mix(np.roll(s, -1) ^ salt)), s)
            s, at, low, high = s[~taken], at[~taken], low[~taken], high[~taken]
    return Symbols(s, at, low, high)


def _starts(t: W.Texts, window: int) -> np.ndarray:
    """Words at which a window begins that lies in one text."""
    at = np.arange(len(t.starts))
    return at[at + window <= np.repeat(t.first[1:], t.counts)]


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where the least of values[begin..end] stands first, for many ranges."""
    best, width = np.arange(len(values)), 1
    out, size = np.empty(len(begin), np.int64), end - begin + 1
    while True:
        here = (size >= width) & (size < 2 * width)
        a, b = best[begin[here]], best[end[here] - width + 1]
        out[here] = np.where(values[b] < values[a], b, a)
        if not (size >= 2 * width).any():
            return out
        later = best[np.minimum(np.arange(len(best)) + width, len(best) - 1)]
        best, width = np.where(values[later] < values[best], later, best), 2 * width


def phrases(t: W.Texts, words: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A phrase for every window: its name, the word at which it begins, and the number of the window.

    Of the phrases of neighbouring low-level symbols that depend on the window's words alone, the one with
    the least name is taken. Equal windows so have equal phrases at equal places, whatever stands around
    them. Windows inside a run or a period, all symbols of which reach out, fall back on plain words."""
    names, places, which = [], [], []
    todo = np.arange(len(starts))
    for level, k in PHRASES.items():
        s = recompress(words, t.first, level)
        m = len(s.names) - k + 1
        if m < 1 or not len(todo):
            continue
        at = np.arange(m)
        named = W.spans_hash(s.names ^ np.uint64(level + 1), at, at + k)
        begin, end = np.searchsorted(s.low[:m], starts[todo]), np.searchsorted(s.high[k - 1 :], starts[todo] + window, "right") - 1
        some = begin <= end
        best = _least(named, begin[some], end[some])
        names.append(named[best])
        places.append(s.at[best])
        which.append(todo[some])
        todo = todo[~some]
    if not names:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(names), np.concatenate(places), np.concatenate(which)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)


def _long(window: int):
    """Keys of each whole text and of its neighbouring high-level symbols. check: a second hash, so that a clash of names is seen."""

    def run(batches):
        for batch in batches:
            ids, tags = _rows(batch)
            for at, to, t in W.texts(batch.column(1)):
                words = t.word_hashes()
                if not len(words):
                    continue
                long = np.flatnonzero(t.counts >= window)
                whole = W.spans_hash(words, t.first[:-1][long], t.first[1:][long])
                s = recompress(words, t.first, ROUNDS)
                end = np.append(s.at[1:], len(words))
                doc = t.doc_of_word()
                with np.errstate(over="ignore"):
                    pair = W.mix(s.names[:-1] * np.uint64(0x9FB21C651E98DF25) + W.mix(s.names[1:]))
                same = (doc[s.at[:-1]] == doc[s.at[1:]]) & (end[1:] - s.at[:-1] >= window)
                begin, stop = np.concatenate([t.first[:-1][long], s.at[:-1][same]]), np.concatenate([t.first[1:][long], end[1:][same]])
                check = (W.spans_hash(W.mix(words), begin, stop) & np.uint64(0x7FFFFFFF)).astype(np.int32)
                d = doc[begin]
                columns = [np.concatenate([whole, pair[same]]).view(np.int64), check, ids[at:to][d], tags[at:to][d], (begin - t.first[:-1][d]).astype(np.int32), (stop - begin).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "check", "doc", "row", "at", "n"])

    return run


def _flat(lists: pa.Array, t: W.Texts) -> tuple[pa.Array, np.ndarray]:
    """The items of one list for each text, and the word at which the text of each item begins."""
    return lists.flatten(), np.repeat(t.first[:-1], pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))


def _open_windows(t: W.Texts, spans: pa.Array, window: int) -> np.ndarray:
    """Windows that no span covers whole."""
    items, base = _flat(spans, t)
    reach = np.zeros(len(t.starts) + 1, np.int64)  # how far spans go that begin here or before
    if len(items):
        begin = items.field("at").to_numpy() + base
        np.maximum.at(reach, begin, begin + items.field("n").to_numpy())
        reach = np.maximum.accumulate(reach)
    starts = _starts(t, window)
    return starts[reach[starts] < starts + window]


def _short(window: int):
    """The phrase of every window that no span covers."""

    def run(batches):
        for batch in batches:
            ids, tags = _rows(batch)
            for at, to, t in W.texts(batch.column(1)):
                names, places, _ = phrases(t, t.word_hashes(), _open_windows(t, batch.column(3).slice(at, to - at), window), window)
                if not len(names):
                    continue
                # one row for each place and name
                order = np.lexsort((names, places))
                names, places = names[order], places[order]
                new = np.ones(len(names), bool)
                new[1:] = (names[1:] != names[:-1]) | (places[1:] != places[:-1])
                names, places = names[new], places[new]
                d = t.doc_of_word()[places]
                columns = [names.view(np.int64), ids[at:to][d], tags[at:to][d], (places - t.first[:-1][d]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc", "row", "at"])

    return run


def _windows(window: int):
    """Two hashes of each window whose phrase other documents have, too, and that no span covers."""

    def run(batches):
        for batch in batches:
            ids, tags = _rows(batch)
            for at, to, t in W.texts(batch.column(1)):
                words = t.word_hashes()
                starts = _open_windows(t, batch.column(3).slice(at, to - at), window)
                _, places, which = phrases(t, words, starts, window)
                shared = np.zeros(len(words) + 1, bool)
                items, base = _flat(batch.column(4).slice(at, to - at), t)
                shared[items.to_numpy() + base] = True
                starts = starts[which[shared[places]]]
                if not len(starts):
                    continue
                with np.errstate(over="ignore"):
                    other = W.mix(words + np.uint64(0x5851F42D4C957F2D))
                d = t.doc_of_word()[starts]
                columns = [W.spans_hash(words, starts, starts + window).view(np.int64), W.spans_hash(other, starts, starts + window).view(np.int64), ids[at:to][d], tags[at:to][d], (starts - t.first[:-1][d]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "doc", "row", "at"])

    return run


def _kept(t: W.Texts, gone: np.ndarray) -> list[bytes]:
    """For each text, its words that are not gone, one space between."""
    left = np.flatnonzero(~gone)
    size = t.ends[left] - t.starts[left] + 1
    stop = np.cumsum(size)
    out = np.append(t.data, np.uint8(0x20))[np.repeat(t.starts[left] - (stop - size), size) + np.arange(size.sum())]
    out[stop - 1] = 0x20
    cuts = np.append(0, stop)[np.searchsorted(left, t.first)]
    data = out.tobytes()
    return [data[a : max(a, b - 1)] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _finish(window: int, digest: bool):
    def run(batches):
        for batch in batches:
            for at, to, t in W.texts(batch.column(1)):
                edge = np.zeros(len(t.starts) + 1, np.int64)
                for column in (2, 3):
                    items, base = _flat(batch.column(column).slice(at, to - at), t)
                    begin = (items.field("at") if column == 2 else items).to_numpy() + base
                    np.add.at(edge, begin, 1)
                    np.subtract.at(edge, begin + (items.field("n").to_numpy() if column == 2 else window), 1)
                gone = np.cumsum(edge[:-1]) > 0
                total = np.append(0, np.cumsum(gone))
                kept = _kept(t, gone)
                kept = [hashlib.sha256(x).hexdigest() for x in kept] if digest else [x.decode() for x in kept]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(t.counts.astype(np.int64)), pa.array(total[t.first[1:]] - total[t.first[:-1]]), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"]
                )

    return run


def dedup_substrings(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row, without the words that a window covers whose
    word sequence also starts in a document with a smaller id. digest: kept_sha256 in place of kept_text.

    Each text is recompressed (`recompress`), and what is compared between documents are its symbols only:

    1. Whole texts and neighbouring high-level symbols are counted by name. Those that an earlier
       document has are long repeats: they are held against a second hash and covered at once.
    2. Windows that no such span covers are looked up by a phrase of their low-level symbols
       (`phrases`). Equal windows have equal phrases, so one whose phrase only its own document has is
       not repeated.
    3. The windows left are verified by two 64-bit hashes of their words.

    A clash of names can make a candidate too many in 2, never lose one. Only keys, numbers and ids are
    shuffled by name. Texts are joined three times with the lists of places found for them.

    Null and empty texts have no words. Rows with a null id are returned whole, and other rows do not
    see them. Rows with the same id do not see each other, as neither id is smaller; equal rows stay
    as many. Windows do not cross texts. Further columns are ignored; an empty table gives an empty one.
    """
    if window < max(PHRASES[0], 7):
        raise ValueError("window: seven words at least")
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    keyed = docs.withColumn("row", F.hash("text"))  # with the id, names a row
    known = keyed.where("doc is not null")
    # tables of owners are written first, so that Spark can split the places of a very common name in the joins
    long = scratch.keep(known.mapInArrow(_long(window), "key long, check int, doc long, row int, at int, n int"), "long")
    owners = scratch.keep(long.groupBy("key", "check").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").drop("most"), "long-owners")
    spans = long.join(owners, ["key", "check"]).where("least < doc").groupBy("doc", "row").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    spans = scratch.keep(spans, "spans")
    scratch.drop("long", "long-owners")
    short = scratch.keep(known.join(spans, ["doc", "row"], "left").select("doc", "text", "row", "spans").mapInArrow(_short(window), "key long, doc long, row int, at int"), "short")
    owners = scratch.keep(short.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("key"), "short-owners")
    places = scratch.keep(short.join(owners, "key").groupBy("doc", "row").agg(F.collect_list("at").alias("marks")), "places")
    scratch.drop("short", "short-owners")
    todo = known.join(places, ["doc", "row"]).join(spans, ["doc", "row"], "left").select("doc", "text", "row", "spans", "marks")
    windows = scratch.keep(todo.mapInArrow(_windows(window), "k1 long, k2 long, doc long, row int, at int"), "windows")
    first = scratch.keep(windows.groupBy("k1", "k2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").drop("most"), "first")
    repeated = windows.join(first, ["k1", "k2"]).where("least < doc").groupBy("doc", "row").agg(F.collect_list("at").alias("starts"))
    gone = scratch.keep(spans.join(repeated, ["doc", "row"], "full"), "gone")
    scratch.drop("windows", "first", "places", "spans")
    out = keyed.join(gone, ["doc", "row"], "left").select("doc", "text", "spans", "starts")
    return out.mapInArrow(_finish(window, digest), "doc_id long, n_words long, n_removed long, kept string").withColumnRenamed("kept", "kept_sha256" if digest else "kept_text")
