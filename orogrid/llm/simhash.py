"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified Hamming distance, components."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.llm import _words as W
from orogrid.llm._shared import Scratch
from orogrid.llm.graph import components

#: Blocks of a fingerprint. Two fingerprints that differ in d bits share at least BLOCKS - d of them.
BLOCKS = 4
#: Fingerprints in one bucket up to which its pairs are compared; beyond, links go through shared neighbours.
BUCKET = 48


def _shingles(t: W.Texts, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, how many each text has, and the text of each."""
    joined, starts, ends = W.lowered_words(t)
    n = t.counts
    shingles = np.where(n == 0, 0, np.maximum(n - words + 1, 1))
    doc = np.repeat(np.arange(len(n)), shingles)
    if not len(doc):
        return np.zeros(0, np.uint64), shingles, doc
    begin = np.cumsum(shingles) - shingles
    first = np.arange(len(doc)) - begin[doc] + t.first[:-1][doc]
    last = np.minimum(first + words, t.first[1:][doc]) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)), np.uint64, len(doc))
    return h, shingles, doc


def _majority(h: np.ndarray, shingles: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each text, the bits that are set in over half of its hashes."""
    some = np.flatnonzero(shingles)
    ones = np.zeros((len(some), 64), np.int64)
    step = 1 << 16
    row = np.searchsorted(some, doc)
    for at in range(0, len(h), step):  # bounded memory for very long texts
        bits = np.unpackbits(h[at : at + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = row[at : at + step]
        cut = np.flatnonzero(np.diff(rows, prepend=-1))
        ones[rows[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    set_bits = (2 * ones > shingles[some][:, None]).astype(np.uint8)
    out = np.zeros(len(shingles), np.uint64)
    if len(some):
        out[some] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def _fingerprints(t: W.Texts, words: int) -> np.ndarray:
    return _majority(*_shingles(t, words))


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long) of every row: word shingles of the text with A-Z lower-cased, XXH64 with seed 42,
    a bit for each that is set in over half of the shingles. Fewer words than `words`: the whole
    sequence is the only shingle. No word or a null text: zero."""
    kind = docs.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for at, to, t in W.texts(batch.column(1)):
                out[at:to] = _fingerprints(t, words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["id", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind.simpleString()}, fingerprint long")


def _block(c: Column, i: int) -> Column:
    width = 64 // BLOCKS
    return F.shiftrightunsigned(c, i * width).bitwiseAND((1 << width) - 1)


def links(prints: DataFrame, bits: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect exactly those distinct fingerprints which a chain of steps of at most
    `bits` (0 to 2) differing bits connects.

    Close pairs share BLOCKS - bits blocks, so each fingerprint goes to one bucket for every such
    choice of blocks, and pairs inside a bucket are verified. A bucket above BUCKET members (many
    variants of one text) is not expanded into pairs: two fingerprints differ in at most two bits
    exactly if they share a neighbour at one bit or less, so members of large buckets meet at the
    least member of each shared neighbour, 65 rows for each; for one bit they are joined with their
    64 neighbours.
    """
    if not 0 <= bits <= 2:
        raise ValueError("bits: 0 to 2")
    prints = prints.select(F.col("fingerprint").alias("f"))
    tables = [F.struct(F.lit(t).alias("t"), sum((F.shiftleft(_block(F.col("f"), b), 16 * k) for k, b in enumerate(which)), F.lit(0).cast("long")).alias("k")) for t, which in enumerate(combinations(range(BLOCKS), BLOCKS - bits))]
    keyed = prints.select("f", F.explode(F.array(*tables)).alias("b")).select("f", "b.t", "b.k")
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    placed = scratch.keep(keyed.join(sizes, ["t", "k"]), "buckets")
    few = placed.where(F.col("n") <= BUCKET)
    one, two = few.select("t", "k", F.col("f").alias("a")), few.select("t", "k", F.col("f").alias("b"))
    close = one.join(two, ["t", "k"]).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits).select("a", "b")
    if not bits:
        return close.limit(0)
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    many = placed.where(F.col("n") > BUCKET).select("f").distinct()
    near = many.select("f", F.explode(flips).alias("x")).select("f", F.col("f").bitwiseXOR(F.col("x")).alias("c"))
    if bits == 1:
        # one bit apart: one is the other with that bit turned over
        return close.union(near.where("f < c").join(many.select(F.col("f").alias("c")), "c").select(F.col("f").alias("a"), F.col("c").alias("b"))).distinct()
    centre = near.groupBy("c").agg(F.min("f").alias("a"), F.max("f").alias("z")).where("a < z")
    return close.union(near.join(centre, "c").where("f <> a").select("a", F.col("f").alias("b"))).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row: component_id is the least id that can be reached over
    links of at most `bits` differing bits.

    Null texts and texts without words have fingerprint zero and link like any other. Rows with a
    null id get component null unless a linked row has an id. Repeated ids: each row has its own
    fingerprint; the component is that of the row. Further columns of docs are ignored; an empty
    table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.keep(fingerprints(docs, words, id_col, text_col), "prints")
    by = scratch.keep(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(by, bits, scratch), scratch)
    named = by.join(roots, by.fingerprint == roots.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = scratch.keep(named.join(least, "root").select("fingerprint", "component_id"), "components")
    return prints.join(of, "fingerprint").select("id", "fingerprint", "component_id")


#: Words of the parity sketch that rules pairs out before their shingles are read.
SKETCH = 4
#: Parts in which the buckets of `similar_documents` are made and its pairs compared, so that the shuffle of one part alone is on disk.
PARTS = 4
#: Ids up to which a list of them is broadcast (under 100 bytes each); a longer one is shuffled.
BROADCAST_IDS = 1_000_000
#: Hashes of common shingles that are broadcast, at most (8 bytes each).
COMMON = 1_000_000
#: Shingles of one chunk of a large bucket (a task holds two), and texts of it that are compared in one matrix product.
CHUNK, BLOCK = 400_000, 128


def _sketches(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, h0, h1, n, s0, ..., shingles) of every row with a word: 128 bits of hash of its set of shingles, their number, a
    parity sketch (each shingle turns one bit over), and the hashes in order."""
    kind = docs.schema[id_col].dataType
    bits = 64 * SKETCH

    def run(batches):
        for batch in batches:
            for at, to, t in W.texts(batch.column(1)):
                h, shingles, _ = _shingles(t, words)
                cuts = np.concatenate([[0], np.cumsum(shingles)])
                some = np.flatnonzero(shingles)
                sets = [np.unique(h[cuts[k] : cuts[k + 1]]) for k in some]
                n = np.array([len(x) for x in sets], np.int64)
                with np.errstate(over="ignore"):
                    named = [np.array([W.mix(x ^ np.uint64(salt)).sum(dtype=np.uint64) for x in sets], np.uint64) for salt in (0, 0x9E3779B97F4A7C15)]
                odd = np.array([np.bincount((x & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1 for x in sets], np.uint8)
                sketch = np.packbits(odd.reshape(-1, bits), axis=1, bitorder="little").view("<i8")
                columns = [*(x.view(np.int64) for x in named), n, *(np.ascontiguousarray(sketch[:, k]) for k in range(SKETCH))]
                hashes = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some + at)), *map(pa.array, columns), hashes], names)

    names = ["id", "h0", "h1", "n", *(f"s{k}" for k in range(SKETCH)), "shingles"]
    schema = f"id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in names[1:-1]) + ", shingles array<long>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _prefix_length(similarity: float) -> Column:
    """Shingles of a set of n of which a similar set must have one, in any order of all shingles."""
    return F.col("n") - _least_shared(F.col("n"), similarity) + 1


def _common(sets: DataFrame, similarity: float, scratch: Scratch) -> np.ndarray:
    """The shingle hashes that over BUCKET texts have near their least ones, in order; no more than COMMON, the most frequent.

    They come last in the order of prefixes. Any set of them gives the same result: those that do not fit make large buckets."""
    near = F.slice("shingles", F.lit(1), (2 * _prefix_length(similarity)).cast("int"))
    floor = BUCKET
    often = scratch.keep(sets.select(F.explode(near).alias("key")).groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > floor), "often")
    while often.where(F.col("m") > floor).count() > COMMON:
        floor *= 2
    keys = often.where(F.col("m") > floor).select("key").toArrow()["key"].to_numpy()
    scratch.drop("often")
    return np.sort(keys.astype(np.int64).view(np.uint64))


def _prefixes(sets: DataFrame, common: np.ndarray, similarity: float) -> DataFrame:
    """sets with, in place of the shingles, the first of them (prefix; see `_prefix_length`) in an order of all: those that
    are not common, then those that are, each by hash. late, end: whether the last of them is common, and its hash."""
    kept = [c for c in sets.columns if c != "shingles"]
    schema = ", ".join(f"{c} {sets.schema[c].dataType.simpleString()}" for c in kept) + ", prefix array<long>, late boolean, end long"
    held = sets.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        often = held.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("shingles"))
            cuts = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy()[cuts[0] : cuts[-1]].view(np.uint64)
            cuts = cuts - cuts[0]
            n = np.diff(cuts)
            length = n - np.ceil(similarity * n - 1e-6).astype(np.int64) + 1
            doc = np.repeat(np.arange(len(n)), n)
            late = np.zeros(len(values), bool)
            if len(often):
                late = often[np.minimum(np.searchsorted(often, values), len(often) - 1)] == values
            before = np.concatenate([[0], np.cumsum(late)])
            lates, ahead = before[cuts[1:]] - before[cuts[:-1]], before[:-1] - before[cuts[:-1]][doc]
            place = np.arange(len(values)) - cuts[:-1][doc]
            rank = np.where(late, (n - lates)[doc] + ahead, place - ahead)
            taken = np.flatnonzero(rank < length[doc])
            taken = taken[np.lexsort((rank[taken], doc[taken]))]
            ends = np.cumsum(length)
            prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values[taken].view(np.int64)))
            last = taken[ends - 1]
            flipped = (values[last] ^ np.uint64(1 << 63)).view(np.int64)  # signed in the order of the unsigned
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), prefix, pa.array(late[last]), pa.array(flipped)], [*kept, "prefix", "late", "end"])

    return sets.mapInArrow(run, schema)


def similar_documents(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first) of documents that fall to one with a smaller id, over links of texts whose sets of word shingles have a
    Jaccard similarity of `similarity` at least.

    Exact but for equal hashes of shingles: two such sets share one of the first n less `_least_shared`
    plus one of either, in any order of all shingles. Here those in many texts come last and the others go
    by hash, so each text goes to a bucket for each of its least hashes (a fifth of them at 0.8), and a
    passage that many texts share makes no bucket unless a text has little else. Pairs go on if the buckets that
    they share, what follows, and the parity sketches (which differ in no more bits than the sets in
    shingles) allow the similarity, and each is verified on the shingles. Large buckets (many variants of one
    text) are first held against their least id only; members of those that this does not
    make one group are all compared with each other by `_dense_links`. A text that fell is compared like
    any other. Texts without words and rows without an id take no part; rows with one id are judged together.
    """
    scratch = Scratch(docs.sparkSession)
    docs = docs.where(F.col(id_col).isNotNull())
    sketches = scratch.keep(_sketches(docs, words, id_col, text_col).withColumn("at", F.monotonically_increasing_id()), "sketches")
    # equal sets first: groups of exact copies end here
    least = scratch.keep(sketches.groupBy("h0", "h1").agg(F.min(F.struct("id", "at")).alias("first")), "distinct")
    copies = sketches.select("id", "h0", "h1").join(least, ["h0", "h1"]).where(F.col("id") != F.col("first.id"))
    copies = scratch.keep(copies.select(F.col("first.id").alias("a"), F.col("id").alias("b")).distinct(), "copies")
    # by file and place: the rows of exact copies go without a shuffle of the shingles where their ids are few enough
    again = scratch.keep(sketches.select("at", "h0", "h1").join(least, ["h0", "h1"]).where(F.col("at") != F.col("first.at")).select("at"), "again")
    few = F.broadcast if again.count() <= BROADCAST_IDS else lambda df: df
    sets = sketches.join(few(again), "at", "left_anti").drop("at", "h0", "h1")
    left = scratch.keep(_prefixes(sets, _common(sets, similarity, scratch), similarity), "left")
    parts = [_bucket_pairs(left.select("id", "n", F.posexplode("prefix").alias("pos", "key")).where(F.pmod("key", F.lit(PARTS)) == k), similarity, scratch, str(k)) for k in range(PARTS)]
    pairs, many = (reduce(DataFrame.union, side) for side in zip(*parts, strict=True))
    pairs = scratch.keep(pairs.groupBy("a", "b").agg(F.sum("c").alias("c"), F.bool_or("room").alias("room")).where("room"), "pairs")
    many = scratch.keep(many, "many")
    scratch.drop(*(f"{name}-{k}" for k in range(PARTS) for name in ("pairs", "many")))
    found = copies.union(scratch.keep(_verified(pairs, left, many, sets, similarity, scratch), "links"))
    scratch.drop("near", "wanted", "sets", "first", "rest", "least-roots")
    roots = scratch.keep(components(found, scratch), "roots")
    named = many.join(roots, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    apart = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    open_ = scratch.keep(named.join(apart, "key").select("id", "root").distinct(), "open")
    if open_.limit(1).count():
        more = scratch.keep(_dense_links(open_, sets, similarity, scratch), "more")
        roots = scratch.keep(components(found.union(more), scratch), "all-roots")
    scratch.drop(*(n for n in tuple(scratch.made) if n not in ("roots", "all-roots")))
    return roots.where("node <> root").select(F.col("node").alias("id"), F.col("root").alias("first"))


def _bucket_pairs(keyed: DataFrame, similarity: float, scratch: Scratch, tag: str) -> tuple[DataFrame, DataFrame]:
    """Of keyed(id, n, pos, key): pairs (a, b, c, room) of texts in one bucket, and (key, id) of large buckets.

    c: buckets of few that a pair shares; room: whether one of them could be the first shingle that two similar sets share."""
    sizes = scratch.keep(keyed.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("lead")).where("m > 1"), f"sizes-{tag}")
    placed = scratch.keep(keyed.join(sizes, "key"), f"placed-{tag}")
    few, many = placed.where(F.col("m") <= BUCKET), placed.where(F.col("m") > BUCKET)
    side = lambda s: few.select("key", F.col("id").alias(s), F.col("n").alias(f"{s}_n"), (F.col("n") - F.col("pos")).alias(f"{s}_rest"))
    # of the first shingle that two sets share, no more follow than the shorter rest has
    room = F.least("a_rest", "b_rest") * (1 + similarity) + 1e-6 >= similarity * (F.col("a_n") + F.col("b_n"))
    pairs = side("a").join(side("b"), "key").where("a < b").select("a", "b", F.lit(1).alias("c"), room.alias("room"))
    pairs = pairs.union(many.where("id > lead").select(F.col("lead").alias("a"), F.col("id").alias("b"), F.lit(0), F.lit(True)))
    pairs = scratch.keep(pairs.groupBy("a", "b").agg(F.sum("c").alias("c"), F.bool_or("room").alias("room")), f"pairs-{tag}")
    many = scratch.keep(many.select("key", "id"), f"many-{tag}")
    scratch.drop(f"sizes-{tag}", f"placed-{tag}")
    return pairs, many


def _least_shared(n: Column, similarity: float) -> Column:
    """Shingles of a set of n that any set at `similarity` or more to it has as well."""
    return F.ceil(n * F.lit(similarity) - F.lit(1e-6))


def _dense_links(some: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Links (a, b) that connect all texts of some(id, root) which verified pairs of them connect beyond their roots.

    Prefix filter: with the shingles of all sets in one order, rare ones first, two similar sets share
    one of the first n less `_least_shared` plus one of either. Buckets of such shingles up to BUCKET
    members are expanded into pairs. Larger ones are dealt into chunks of about CHUNK shingles, and
    every pair of chunks is compared whole by one task, which returns no more links than it has texts.
    """
    sets = scratch.keep(sets.select("id", "shingles").join(some, "id").distinct().select(F.monotonically_increasing_id().alias("at"), "id", "root", F.size("shingles").alias("n"), "shingles"), "dense-sets")
    flat = sets.select("at", "id", "root", "n", F.explode("shingles").alias("key"))
    times = scratch.keep(flat.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "dense-times")
    # shingles of one set alone come first in the order; they need no rows, only their number
    shared = flat.join(times, "key").groupBy("at", "id", "root", "n").agg(F.sort_array(F.collect_list(F.struct("m", "key"))).alias("keys"))
    length = F.greatest(F.lit(0), F.col("n") - _least_shared(F.col("n"), similarity) + 1 - (F.col("n") - F.size("keys"))).cast("int")
    rows = shared.select("at", "id", "root", "n", F.explode(F.slice("keys", F.lit(1), length)).alias("k")).select("at", "id", "root", "n", "k.key")
    rows = scratch.keep(rows, "dense-rows")
    sizes = scratch.keep(rows.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("weight"), F.min("root").alias("x"), F.max("root").alias("y")).where("x < y"), "dense-sizes")
    placed = rows.join(sizes, "key")
    few = placed.where(F.col("m") <= BUCKET)
    side = lambda s: few.select("key", F.col("at").alias(s), F.col("root").alias(f"{s}_root"), F.col("n").alias(f"{s}_n"))
    pairs = side("a").join(side("b"), "key").where("a < b and a_root <> b_root").where(F.least("a_n", "b_n") >= _least_shared(F.greatest("a_n", "b_n"), similarity)).select("a", "b").distinct()
    part = lambda s, x: sets.select(F.col("at").alias(s), F.col("id").alias(f"{s}_id"), F.col("shingles").alias(x))
    both = pairs.join(part("a", "x"), "a").join(part("b", "y"), "b")
    both = both.where(_alike("x", "y", similarity)).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    # a chunk meets each chunk of its bucket once: the pair is named by the lower and the higher one
    count = F.ceil(F.col("weight") / CHUNK).cast("int")
    dealt = placed.where(F.col("m") > BUCKET).select("at", "key", F.pmod(F.xxhash64("at"), count).cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), count - 1)).alias("other"))
    dealt = dealt.select("at", "key", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    kind = sets.schema["id"].dataType.simpleString()
    wide = dealt.join(sets.select("at", "id", "root", "shingles"), "at").select("key", "low", "high", (F.col("chunk") == F.col("low")).alias("lower"), "id", "root", "shingles")
    return both.union(wide.groupBy("key", "low", "high").applyInArrow(_chunk_links(similarity), f"a {kind}, b {kind}")).distinct()


def _chunk_links(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        ids, roots = table["id"].combine_chunks(), table["root"].combine_chunks()
        label = roots.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lists = table["shingles"].combine_chunks()
        values, cuts = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        size = np.diff(cuts)
        lower = table["lower"].to_numpy().astype(bool)
        one, two = (np.flatnonzero(lower), np.flatnonzero(~lower)) if not lower.all() else (np.arange(len(ids)),) * 2
        a, b = [], []
        for i in range(0, len(one), BLOCK):
            rows = one[i : i + BLOCK]
            known, column = np.unique(np.concatenate([values[cuts[r] : cuts[r + 1]] for r in rows]), return_inverse=True)
            left = np.zeros((len(rows), len(known)), np.float32)
            left[np.repeat(np.arange(len(rows)), size[rows]), column] = 1
            for j in range(0, len(two), BLOCK):
                others = two[j : j + BLOCK]
                if len(np.unique(label[np.concatenate([rows, others])])) == 1:
                    continue
                v = np.concatenate([values[cuts[r] : cuts[r + 1]] for r in others])
                place = np.minimum(np.searchsorted(known, v), len(known) - 1)
                hit = known[place] == v
                right = np.zeros((len(others), len(known)), np.float32)
                right[np.repeat(np.arange(len(others)), size[others])[hit], place[hit]] = 1
                shared = left @ right.T
                alike = shared >= similarity * (size[rows][:, None] + size[others][None, :] - shared.astype(np.float64))
                for r, near in zip(rows[alike.any(axis=1)], alike[alike.any(axis=1)], strict=True):
                    group = others[near]
                    new, which = np.unique(label[group], return_index=True)
                    for g in group[which[new != label[r]]]:  # a link for each group that this text joins
                        a.append(r)
                        b.append(g)
                    label[np.isin(label, new)] = label[r]
        return pa.table({"a": ids.take(pa.array(a, pa.int64())), "b": ids.take(pa.array(b, pa.int64()))})

    return run


def _alike(x: str, y: str, similarity: float) -> Column:
    shared = F.size(F.array_intersect(x, y))
    return shared >= similarity * (F.size(x) + F.size(y) - shared)


def _verified(pairs: DataFrame, left: DataFrame, many: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Links (a, b) that connect what the similar ones of these pairs connect.

    Of the shingles up to the end of the shorter prefix, two sets share the buckets that they share (those
    of few are counted, of large ones each has a number); of what follows, no more than that set has. Pairs
    for which this and the parity sketches leave the similarity possible are compared on their shingles.
    Each text is held against its least candidate first. Pairs that the links so found connect already are
    not read again, so that a group of variants costs about as many comparisons as it has texts."""
    held = left.join(many.groupBy("id").agg(F.count("*").alias("large")), "id", "left").withColumns(
        # end: the place of the prefix's last shingle in the order of all
        {"large": F.coalesce("large", F.lit(0)), "end": F.struct("late", "end"), "rest": F.col("n") - F.size("prefix")}
    )
    side = lambda s: held.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "large", "end", "rest")], *[F.col(f"s{k}").alias(f"{s}{k}") for k in range(SKETCH)])
    after = F.when(F.col("a_end") <= F.col("b_end"), F.col("a_rest")).otherwise(F.col("b_rest"))
    possible = F.col("c") + F.least("a_large", "b_large") + after + 1e-6 >= (F.col("a_n") + F.col("b_n")) * F.lit(similarity / (1 + similarity))
    odd = sum((F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in range(SKETCH)), F.lit(0))
    # sets at this similarity differ in no more than that part of their shingles
    close = odd <= (F.col("a_n") + F.col("b_n")) * F.lit((1 - similarity) / (1 + similarity)) + 1e-6
    near = scratch.keep(pairs.join(side("a"), "a").join(side("b"), "b").where(close & possible).select("a", "b").distinct(), "near")
    scratch.drop("left", "pairs")
    wanted = scratch.keep(near.select(F.explode(F.array("a", "b")).alias("__wanted")).distinct(), "wanted")
    few = F.broadcast if wanted.count() <= BROADCAST_IDS else lambda df: df
    sets = scratch.keep(sets.select("id", "shingles").join(few(wanted), F.col("id") == F.col("__wanted"), "left_semi"), "sets")
    first = scratch.keep(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first")
    links = _alike_pairs(first, sets, similarity, scratch, "least")
    roots = scratch.keep(components(links, scratch), "least-roots")
    rest = near.join(first, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        rest = rest.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
    rest = rest.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
    return links.union(_alike_pairs(scratch.keep(rest, "rest"), sets, similarity, scratch, "more"))


def _alike_pairs(pairs: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch, tag: str) -> DataFrame:
    """The pairs (a, b) whose shingles are similar, in PARTS parts by b, so that the shingles of one part alone are on disk twice."""
    parts = []
    for k in range(PARTS):
        mine = lambda c: F.pmod(F.xxhash64(c), F.lit(PARTS)) == k  # noqa: B023, E731
        both = pairs.where(mine("b")).join(sets.where(mine("id")).select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
        both = both.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
        parts.append(scratch.keep(both.where(_alike("x", "y", similarity)).select("a", "b"), f"{tag}-{k}"))
    return reduce(DataFrame.union, parts)


def keep_first(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that fall to no similar document with a smaller id (see `similar_documents`).

    Rows with a null id stay, as do null texts and texts without words: they are no copies of each other.
    """
    goes = similar_documents(docs, words, similarity, id_col, text_col).select(F.col("id").alias("__gone")).distinct()
    return docs.join(goes, F.col(id_col) == F.col("__gone"), "left_anti")
