"""Operators against brute force, with nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import math
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from orogrid.llm import chat, decontaminate, fertility, graph, linededup, mixing, pii, recompress, simhash, urlmodel, warc
from orogrid.llm._shared import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor sit amet consectetur " * 4000
P = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
#: doc_id, text: null and empty texts, a null id, repeated rows, a repeated id, copies and near copies, a long text.
DOCS = [
    (1, P), (2, None), (3, ""), (4, P + " end"), (4, P + " end"), (5, "x " + P), (None, P), (6, " \n\t "), (7, LONG), (8, LONG), (9, "A b"), (9, "different text for one id " + P),
    (10, "a b c d e f g h\nA b c d e f g h\nx y z\nx  y z \nq"), (11, "a b c d e f g h i\nx y z\n\nlast line of text here é😀"), (12, "a a a a a a a a a a a a a a a a a a"), (13, "a a a a a a a a a a a a a a a a a a a a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names the operators use themselves."""
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    for c in ("row", "doc", "key", "size", "kept", "id", "line", "n", "at", "fingerprint", "score", "items", "host"):
        df = df.withColumn(c, F.lit("own"))
    return df.withColumns({"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")))}).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words(t):
    return WORD.findall(t or "")


# 1


def base_rules(x):
    x = x or ""
    w = words(x)
    seen, dup = set(), 0
    for line in x.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = [0] * len(w)
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            hit[i : i + 5] = [1] * 5
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, sum(hit)


def test_fertility(docs, empty):
    got = fertility.assess(docs).collect()
    assert len(got) == len(DOCS)
    for r in got:
        b = base_rules(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 10 or 100 * b[4] > 20 * b[0])
        assert not (r.kept and r.base_failed)
        assert r.row.kept == "own"
    assert fertility.assess(empty).count() == 0


def test_fertility_of_pieces(spark):
    import pyarrow as pa
    import sentencepiece

    from orogrid.llm import _words

    encoding = fertility._encoder(fertility.VOCABULARY)
    for text in ("word " * 50_000, "x  y z\n" * 20_000, "é" * 1000, "", "short one"):
        ids = encoding.encode_ordinary(text)
        counts = collections.Counter(ids)
        bits = -sum(v / len(ids) * math.log2(v / len(ids)) for v in counts.values()) if ids else 0
        n, h = fertility._tokens(text, encoding)
        assert n == len(ids) and h == pytest.approx(bits, abs=1e-9)
    p = sentencepiece.SentencePieceProcessor(model_file=fertility.PIECES)
    texts = ["plain words here here", None, "", "𓀀𓀁 hieroglyphs 𓀀", "x" * 70_000, "naïve 日本語 テキスト"]
    want = [(sum(len(p.encode(w[i : i + fertility.PIECE])) for w in words(t) for i in range(0, len(w), fertility.PIECE)), sum(p.is_byte(i) for w in words(t) for i in p.encode(w))) for t in texts]
    got = []
    for _, _, t in _words.texts(pa.array(texts)):
        got += zip(*(x.tolist() for x in fertility._word_pieces(t, *fertility._processor(fertility.PIECES))), strict=True)
    assert got == want and want[3][1] >= 12
    # a script that the vocabulary lacks is measured, and rejected in a language that should not have it
    rows = [(1, "𓀀𓀁𓀂 and then some english words follow in this text of more than ten words", "en"), (2, "some english words follow in this text of more than ten words here", "en")]
    kept = {r.row.doc_id: (r.in_band, r.byte_share > 0) for r in fertility.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == {1: (False, True), 2: (True, False)}


def test_verdicts_against_brute_force(spark):
    """in_band and kept from the measures alone: outer bands, then medians and median deviations by language."""
    import statistics

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = fertility.assess(docs).collect()
    even = lambda r: r.token_entropy / math.log2(min(max(r.n_tokens, 2), 1000))
    measures = {"chars_per_token": lambda r: r.chars_per_token, "chars_per_piece": lambda r: r.chars_per_piece, "byte_share": lambda r: r.byte_share, "evenness": even}
    near = {}
    for band in {r.band for r in rows}:
        some = [r for r in rows if r.band == band and not r.base_failed]
        for c, f in measures.items():
            values = [math.floor(f(r) * 1000 + 0.5) / 1000 for r in some]
            mid = statistics.median(values) if values else 0
            near[band, c] = len(some), mid, statistics.median(math.floor(abs(f(r) - mid) * 1000 + 0.5) / 1000 for r in some) if some else 0
    verdicts = collections.Counter()
    for r in rows:
        low, high, least, most, share, flat = fertility.BANDS[r.band]
        inside = low <= r.chars_per_token <= high and least <= r.chars_per_piece <= most and r.byte_share <= share and r.token_entropy >= flat * math.log2(min(max(r.n_tokens, 2), 1000))
        assert r.in_band == inside
        fits = True
        for c, f in measures.items():
            below, above, floor = fertility.AROUND[c]
            n, mid, dev = near[r.band, c]
            off = (f(r) - mid) / max(dev * 1.4826, floor) / max(1, math.sqrt(fertility.FULL / max(r.n_tokens, 1)))
            fits &= n < fertility.LEAST_TEXTS or ((below is None or off >= -below) and (above is None or off <= above))
        assert r.kept == (not r.base_failed and inside and fits), r
        verdicts[r.kept, r.base_failed] += 1
    assert verdicts[True, False] and verdicts[False, True]


def test_fertility_keeps_clean_and_drops_odd(spark):
    import random

    rng = random.Random(3)
    vocabulary = ["".join(rng.choice(("st", "ra", "mo", "en", "li", "ta", "ke", "or")) for _ in range(rng.randint(1, 3))) for _ in range(500)]
    clean = [(i, " ".join(rng.choices(vocabulary, k=300)), "en") for i in range(60)]
    odd = [(100, " ".join("#%& @!~" + str(rng.random()) for _ in range(150)), "en")]
    got = {r.row.doc_id: r.kept for r in fertility.assess(spark.createDataFrame(clean + odd, "doc_id long, text string, lang string")).collect()}
    assert all(got[i] for i in range(60)) and not got[100]


# 2


def test_urls_against_brute_force(spark):
    urls = [None, "", "nothing", "HTTP://EXAMPLE.org/es/É?x", "x://", "a://b.fr/c d#e", "http://a.com/fr/1", "http://com/fr", "http://xcom/fr/"]
    urls += [f"http://s{i % 7}.example.org/{'es' if i % 3 else 'en'}/{i}" for i in range(60)] + [f"https://w{i % 5}.com/{'fr' if i % 2 else 'de'}/{i}" for i in range(60)] + [f"http://z{i}.net/p{i % 4}" for i in range(30)]
    rows = [(i, u, "own") for i, u in enumerate(urls)] + [(0, None, "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = sorted(((r.row.page_id, r.host, r.path, r.rule, r.verdict) for r in urlmodel.filter_urls(pages).collect()), key=str)
    parsed = []
    for i, u, _ in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        h, p = (re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]) if m else ("", "")
        fit = [(len(n), n, v) for n, v in urlmodel.RULES if (h == n.partition("/")[0] or h.endswith("." + n.partition("/")[0])) and p.startswith("/" + n.partition("/")[2])]
        parsed.append((i, h, p, max(fit)[1:] if fit else None))
    times = collections.Counter(h + p for _, h, p, _ in parsed)
    good = {h + p: None if b is None else b[1] == "allow" for _, h, p, b in parsed}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    held = {a: signed(xxhash.xxh64_intdigest(a.encode(), 42)) % urlmodel.FOLDS == 0 for a in times}
    k = urlmodel.ORDER
    grams = lambda a: [("\2" * k + re.sub(r"[^\x21-\x7e]", "\1", a))[i : i + k + 1] for i in range(len(a))]
    model = [collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)]
    for a, n in times.items():
        if good[a] is not None and not held[a]:
            for g in grams(a):
                for o in range(k + 1):
                    model[not good[a]][g[k - o : k]][g[k]] += n

    def prob(m, g):
        p = 1 / 97
        for o in range(k + 1):
            f = m.get(g[k - o : k])
            if f:
                p = (f[g[k]] + len(f) * p) / (sum(f.values()) + len(f))
        return p

    score = {a: sum(round(math.log(prob(model[0], g) / prob(model[1], g)) * 1e6) for g in grams(a)) / len(a) / 1e6 if a else 0.0 for a in times}
    bins = collections.defaultdict(lambda: [0, 0])
    for a in times:
        if held[a] and good[a] is not None:
            bins[math.floor(max(-10, min(10, score[a])) * 100)][not good[a]] += 1
    g, b = sum(x[0] for x in bins.values()), sum(x[1] for x in bins.values())
    at = 0.0
    if g and b:
        best, at, passed, stopped = 0.5, min(bins), g, 0
        for x in sorted(bins):
            if (passed / g + stopped / b) / 2 > best:
                best, at = (passed / g + stopped / b) / 2, x
            passed, stopped = passed - bins[x][0], stopped + bins[x][1]
        at /= 100
        assert best > 0.9  # held-out accuracy
    want = sorted(((i, h, p, r[0] if r else None, r[1] if r else "allow" if score[h + p] >= at else "block") for i, h, p, r in parsed), key=str)
    assert got == want
    assert urlmodel.filter_urls(pages.limit(0)).count() == 0
    alone = urlmodel.filter_urls(spark.createDataFrame([(1, "http://z.net/a")], "page_id long, url string")).first()
    assert alone.verdict == "allow"


# 3


def within_one(a, b):
    m = min(len(a), len(b))
    head = next((i for i in range(m) if a[i] != b[i]), m)
    tail = next((i for i in range(m) if a[-1 - i] != b[-1 - i]), m)
    return abs(len(a) - len(b)) <= 1 and head + tail >= max(len(a), len(b)) - 1


def test_lines(spark, docs, empty):
    many = [(100 + i, f"this line has the number {i} in its middle and goes on\nunlike {i * 37} {i * 11} {i * 5}") for i in range(120)]  # one large group of variants
    extra = spark.createDataFrame(many, "doc_id long, text string")
    both = docs.select("doc_id", "text", "row", "line").unionByName(extra, allowMissingColumns=True)
    rows = [(r.doc_id, r.text, r.h) for r in both.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()]
    order = sorted({(i is None, i or 0, h, t) for i, t, h in rows if t is not None})
    first = {}
    for n, (none, i, h, t) in enumerate(order):
        for k, line in enumerate(t.split("\n")):
            w = tuple(words(line))
            if len(w) >= linededup.LEAST_WORDS:
                first.setdefault(w, (n, k))
    fell = {w for w in first for v in first if len(w) >= 8 and len(v) >= 8 and v != w and first[v] < first[w] and within_one(w, v)}
    place = {(none, i, h): n for n, (none, i, h, _) in enumerate(order)}
    want = []
    for i, t, h in rows:
        if t is None:
            want.append((i, None, 0, 0))
            continue
        lines, keep = t.split("\n"), []
        for k, line in enumerate(lines):
            w = tuple(words(line))
            if len(w) < linededup.LEAST_WORDS or (first[w] == (place[i is None, i or 0, h], k) and w not in fell):
                keep.append(line)
        want.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    got = [(r.row.doc_id, r.text, r.n_lines, r.n_dropped) for r in linededup.dedup_lines(both).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(g[3] for g in got)
    assert linededup.dedup_lines(empty).count() == 0


def test_lines_of_any_length(spark):
    rows = [(1, "话语没有空格\nHome\n\nshort line"), (2, "话语没有空格\nHome\nother\n\nshort  line"), (3, "Home")]
    got = {r.row.doc_id: (r.text, r.n_dropped, r.n_left) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), least_words=1).collect()}
    assert got == {1: ("话语没有空格\nHome\n\nshort line", 0, 3), 2: ("other\n", 3, 1), 3: ("", 1, 0)}


# 4


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def base_spans(x):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p[-9:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for kind, pattern, low, high, ok in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19, luhn), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15, bool)):
        for m in re.finditer(pattern, x):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and ok(digits):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


HARD = [
    None, "", "a@b@c.d a@b.@c.d x@y.z_q@r.s ..@a.b.c.", "1.2.3.4.5.6.7.8 0256.1.1.1 00255.1.1.1 999999999999999.1.1.1 1.2.3 0.0.0.0", "4111 1111 1111 1111-2 4111111111111111 4111-1111-1111-1111 4  1",
    "+1 (555) 123-4567. +123 +1234567890123456 é +4 4 4 4 4 4 4 4 4 4", "é😀 4111111111111111 x@y.zz", "1" * 5000 + ".1.1.1", "a." * 3000 + "@" + "b." * 3000 + "c", "x" * 200_000, "+1.1.1.1+2(3)4-5 6.7", "@", "a@b", "9",
]


def test_personal_data(spark, empty):
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(HARD)] + [(3, HARD[3], "own"), (None, HARD[6], "own")], "doc_id long, text string, base string")
    got = pii.find(df).collect()
    assert len(got) == len(HARD) + 2
    for r in got:
        t = HARD[r.row.doc_id if r.row.doc_id is not None else 6] or ""
        assert [tuple(s) for s in r.base] == base_spans(t)
        assert set(r.base) <= set(r.spans)
    assert pii.find(empty).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    card = lambda i: next(f"{4000000000000000 + i * 10 + c}" for c in range(10) if luhn(f"{4000000000000000 + i * 10 + c}"))
    rows = [(i, f"he paid by card number {card(i)} at noon") for i in range(40)]
    rows += [(100, "she paid by card number 4000000000000001 too"), (101, "the year was 1999 and page number 4000000000000001 missing"), (102, "nothing here")]
    got = {r.doc_id: r.s for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", pii.listed(F.col("spans")).alias("s")).collect()}
    assert got[100] == "card:24:40"  # fails Luhn, found by its context
    assert got[101] == "" and got[102] == "" and got[0].startswith("card:23")


def test_patterns_find_planted_identifiers(spark):
    """Precision and recall on planted identifiers that the forms miss, among numbers that are none."""
    import random

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    phone = lambda: f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    token = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    card = lambda: "".join(rng.choice("0123456789") for _ in range(16))
    rows, planted = [], {}
    for i in range(300):
        words = [word() for _ in range(20)]
        if i % 3 == 0:
            words.insert(5, phone())
        if i % 3 == 1:
            words.insert(8, f'token = "{token()}"')
        if i % 4 == 0:
            words.insert(12, card())  # nearly all fail the check of digits
        if i % 5 == 0:
            words.insert(3, f"page {rng.randint(1, 400)} of version {rng.randint(1, 9)}.{rng.randint(0, 9)}")
        hidden = None
        if i % 150 == 3:
            hidden = ("phone", phone())
            words.insert(15, f"{hidden[1]} 10.{rng.randint(100, 255)}.{rng.randint(100, 255)}.1")  # the form runs on into the address
        if i % 30 == 4:
            hidden = ("secret", token().upper())
            words.insert(15, f'TOKEN = "{hidden[1]}"!!')
        text = " ".join(words)
        if hidden:
            planted[i] = f"{hidden[0]}:{text.index(hidden[1])}:{text.index(hidden[1]) + len(hidden[1])}"
        rows.append((i, text))
    out = pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).select("row.doc_id", pii.listed(F.col("base")).alias("base"), pii.listed(F.col("spans")).alias("spans")).collect()
    new = {(r.doc_id, s) for r in out for s in set(r.spans.split(",")) - set(r.base.split(",")) if s}
    phones = {(i, s) for i, s in planted.items()}
    assert len(phones) == 12 and phones <= new  # recall 1
    extra = new - phones
    assert all(s.startswith("secret") for _, s in extra)  # the quoted seeds themselves; no number is taken for an identifier
    assert len(extra) == sum("token = " in t for _, t in rows)


def test_offsets(spark):
    from orogrid.llm._shared import offsets

    rows = [(list(range(n)),) for n in (0, 1, 2, 3, 10, 101)]
    got = spark.createDataFrame(rows, "x array<int>").select("x", offsets(F.col("x")).alias("y")).collect()
    assert all(r.y == [sum(r.x[:k]) for k in range(len(r.x))] for r in got)


# 5


def kept_after(rows, window):
    owner = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1) if i is not None else []:
            key = tuple(w[k : k + window])
            owner[key] = min(owner.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [0] * len(w)
        for k in range(len(w) - window + 1) if i is not None else []:
            if owner[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [1] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("window", [7, 13])
def test_substrings(spark, docs, empty, window):
    import random

    rng = random.Random(window)
    passage = [" ".join(rng.choices("abcdefgh", k=40)) for _ in range(3)]
    more = [(100 + i, " ".join(rng.choices("abc", k=rng.randint(0, 60))) + " " + rng.choice(passage) + " " + " ".join(rng.choices("xyz", k=20))) for i in range(60)]
    df = docs.select("doc_id", "text", "key").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = [tuple(r) for r in recompress.dedup_substrings(df, window).collect()]
    assert sorted(got, key=str) == sorted(kept_after(DOCS + more, window), key=str)
    digests = {(r.doc_id, r.kept_sha256) for r in recompress.dedup_substrings(df, window, digest=True).collect()}
    assert digests == {(i, hashlib.sha256(k.encode()).hexdigest()) for i, _, _, k in got}
    assert recompress.dedup_substrings(empty).count() == 0


def test_equal_passages_share_interior_symbols():
    """What a symbol depends on is told: equal words from low to high give the symbol at the same place, at every level."""
    import numpy as np

    from orogrid.llm import _words

    rng = np.random.default_rng(1)
    for size in (2, 50):  # with many runs and periods, and with few
        a = _words.mix(rng.integers(0, size, 400).astype(np.uint64))
        b = np.concatenate([_words.mix(np.arange(77, dtype=np.uint64)), a, a[:30]])
        for rounds in (0, 1, 3, 6):
            sa, sb = (recompress.recompress(x, np.array([0, len(x)]), rounds) for x in (a, b))
            have = set(zip(sb.names.tolist(), (sb.at - 77).tolist(), strict=True))
            inside = (sa.low >= 0) & (sa.high <= len(a))
            assert inside.any() and set(zip(sa.names[inside].tolist(), sa.at[inside].tolist(), strict=True)) <= have
            assert (np.diff(sa.low) >= 0).all() and (np.diff(sa.high) >= 0).all()


def test_nothing_is_found_without_symbols(spark, monkeypatch):
    """All repeats come through symbols: with random names none is left."""
    import random

    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(30)] + passage[: 20 + i] + [word() for _ in range(30)])) for i in range(30)] + [(90 + i, " ".join(passage)) for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(tuple(r) for r in recompress.dedup_substrings(df).collect()) == sorted(kept_after(rows, 13))
    real = recompress._long, recompress._short, recompress._windows

    def blind(make):
        def made(window):
            inner = make(window)

            def run(batches):
                import numpy as np

                plain = recompress.recompress

                def random_names(words, first, rounds):
                    s = plain(words, first, rounds)
                    return s._replace(names=np.random.default_rng().integers(0, 1 << 63, len(s.names)).astype(np.uint64))

                recompress.recompress = random_names
                try:
                    yield from inner(batches)
                finally:
                    recompress.recompress = plain

            return run

        return made

    for name, make in zip(("_long", "_short", "_windows"), real, strict=True):
        monkeypatch.setattr(recompress, name, blind(make))
    different = [(i, f"{t} e{i}") for i, t in rows]  # no two whole texts alike
    got = recompress.dedup_substrings(spark.createDataFrame(different, "doc_id long, text string")).collect()
    assert sum(r.n_removed for r in got) == 0


# 6


def test_chats(spark):
    hard = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "user", "a<+>b"), (1, 1, "user", "<<=x>>&lt;"), (1, 2, "tool>", "</s>\n<s>"), (1, 3, None, None), (1, 4, "assistant", ""), (1, 5, "assistant", "[/INST]&amp;[INST]"), (1, 5, "assistant", "[/INST]&amp;[INST]"),
        (None, 0, "=", "q"), (2, 0, "system", ""), (-7, 1, "assistant", hard), (-7, 0, "user", hard), (3, 0, "assistant", LONG), (4, None, "user", "é😀"),
    ]
    rows += [(5, k, "user" if k % 3 else "assistant", f"turn {k}") for k in range(500)]
    df = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, turns string").repartition(3)
    out = {r.conv_id: r for r in chat.read_chats(chat.format_chats(df)).collect()}
    want = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert set(out) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in out[c].turns] == turns
        assert out[c].loss == "".join(t for role, t in turns if role == "assistant")
    assert chat.format_chats(df.limit(0)).count() == 0


# 7


def test_water_fill():
    assert mixing.water_fill([100, 100], [1, 3]) == [50.0, 150.0]
    assert mixing.water_fill([10, 1000], [1, 1]) == [30.0, 980.0]
    assert mixing.water_fill([0, 0], [1, 2]) == [0.0, 0.0]


def test_flow_routes_overlapping_sources_at_least_cost():
    # 100 words only in a, 100 in both, 50 only in b; a wants 150, b 150
    use = mixing.route([((0,), 100), ((0, 1), 100), ((1,), 50)], [150, 150])
    assert sum(u.get(0, 0) for u in use) == 150 and sum(u.get(1, 0) for u in use) == 150
    taken = [sum(u.values()) for u in use]
    assert all(t <= 3 * s for t, s in zip(taken, (100, 100, 50), strict=True))
    assert sum(max(0, t - s) for t, s in zip(taken, (100, 100, 50), strict=True)) == 50  # only what is lacking is repeated


def test_flow_is_optimal_by_brute_force():
    """The least repetition cost over all integer routings of small overlapping patterns, with as many words as can be routed."""
    import itertools
    import random

    rng = random.Random(6)
    for _ in range(25):
        patterns = [((0,), rng.randint(0, 3)), ((1,), rng.randint(0, 3)), ((0, 1), rng.randint(0, 3))]
        quotas = [rng.randint(0, 7), rng.randint(0, 7)]
        cost = lambda n, size: sum((k // size if size else 0) for k in range(n))
        best = None
        for a, b, x, y in itertools.product(range(10), repeat=4):  # words of each pattern for each of its sources
            if a > 3 * patterns[0][1] or b > 3 * patterns[1][1] or x + y > 3 * patterns[2][1] or a + x > quotas[0] or b + y > quotas[1]:
                continue
            value = (-(a + b + x + y), cost(a, patterns[0][1]) + cost(b, patterns[1][1]) + cost(x + y, patterns[2][1]))
            best = min(best or value, value)
        use = mixing._flow([m for m, _ in patterns], [n for _, n in patterns], quotas)
        taken = [sum(u.values()) for u in use]
        assert (-sum(taken), sum(cost(t, n) for t, (_, n) in zip(taken, patterns, strict=True))) == best
        assert all(sum(u.get(j, 0) for u in use) <= q for j, q in enumerate(quotas))
    many = mixing._flow([(i,) for i in range(20_000)], [10] * 20_000, [5, 40] * 10_000)  # sources on their own take no flow
    assert many[0] == {0: 5} and many[1] == {1: 30}


def test_mixture(spark, docs, empty):
    import random

    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", None])) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("own"))
    run = lambda n: sorted((r.doc_id, r.s, r.target, r.taken, r.size) for r in mixing.mix(mixing.count_words(df.repartition(n)), F.array("row.source"), key=F.col("row.doc_id")).select("row.doc_id", F.col("source_sizes")[0].alias("s"), F.col("targets")[0].alias("target"), "taken", "size").collect())
    got = run(2)
    assert got == run(5)
    size = {i: len(t.split()) for i, t, _ in rows}
    total = collections.Counter()
    for i, _, s in rows:
        total[s] += size[i]
    names = sorted((s for s in total if s is not None)) + [None]
    want = dict(zip(names, mixing.water_fill([total[n] for n in names], [1, 2, 3, 1]), strict=True))
    taken = collections.Counter()
    for (i, s, target, t, n), (_, _, source) in zip(got, rows, strict=True):
        assert n == size[i] and s == total[source] and target == pytest.approx(want[source])
        assert 0 <= t <= 3 * n and (n == 0 or t % n == 0)
        taken[source] += t
    assert all(abs(taken[n] - want[n]) <= 60 for n in names)
    assert mixing.mix(mixing.count_words(empty), F.array("row.source")).count() == 0
    assert mixing.mix(mixing.count_words(docs), F.array("row.source")).count() == len(DOCS)


# 8


def test_archives(spark):
    rows = [
        (1, "u\r\n", "\r\n\r\n"), (2, None, None), (3, "x", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (4, "x", "\r\n"), (5, "é", "é\r\n\r\n\r\n\r\nb"), (6, "x", "\r\n\r\n\r\n"), (7, "q", "z" * 1000), (8, "q", "z" * 1000),
        (9, "q", "z" * 999), (10, "q", "z" * 999), (8, "q", "z" * 1000), (11, "", "\n\r\n\r\n\r"), (12, "l", LONG), (13, "l", LONG),
    ]
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    got = [(int(r.capture), r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None, bytes(r.payload).decode()) for r in warc.captures(df, payload=True).collect()]
    top = {}
    for i, _, h in rows:
        top[h] = max(top.get(h, i), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 1000 and top[h] != i
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top[h] if again else None, "" if again else h or ""))
    assert sorted(got, key=str) == sorted(want, key=str)
    full = warc.captures(df).collect()
    assert all(r.request.id and r.metadata.id for r in full)
    assert warc.captures(df.limit(0)).count() == 0


def test_archives_are_whole(spark, tmp_path):
    rows = [(i, f"http://h{i}.net/p?q={i}#x", "y" * 1200 if i < 5 else f"page {i}") for i in range(30)] + [(None, None, "y" * 1200), (None, "u", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = warc.captures(df, path=str(tmp_path / "a")).collect()
    assert len(got) == 32
    assert sorted((r.capture, r.refers_to) for r in got if r.record_type == "revisit") == [(str(i), "4") for i in range(4)]
    records = warc.read_records(spark, str(tmp_path / "a")).collect()
    ids = {r.record_id for r in records if r.type == "response"}
    assert {r.refers_to for r in records if r.type == "revisit"} <= ids  # a real record
    assert b"GET /p?q=7 HTTP/1.1\r\nHost: h7.net" in {bytes(r.http_head) for r in records if r.type == "request"}
    import gzip

    (packed,) = (tmp_path / "a").glob("*.gz")
    data = gzip.decompress(packed.read_bytes())
    plain, torn = tmp_path / "plain.warc", tmp_path / "torn.warc.gz"
    plain.write_bytes(data)
    torn.write_bytes(gzip.compress(data[: len(data) // 2]))
    assert warc.read_records(spark, str(plain)).count() == len(records)  # not compressed, in one piece
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        with pytest.raises(Exception, match="is split between tasks"):
            warc.read_records(spark, str(plain)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(spark, str(torn)).collect()


# 9


def fingerprint(x, k):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), x or ""))
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints(docs, empty):
    for k in (3, 5):
        got = {(r.id, r.fingerprint % 2**64) for r in simhash.fingerprints(docs, k).collect()}
        assert got == {(i, fingerprint(t, k)) for i, t in DOCS}
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_lose_none(spark, bits):
    import random

    rng = random.Random(bits)
    centre = [rng.getrandbits(64) for _ in range(40)]
    values = set(centre)
    for c in centre[:20]:
        for _ in range(6):
            values.add(c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values |= {centre[0] ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(16)}  # a bucket far above BUCKET
    values |= {centre[1] ^ (1 << a) for a in range(64)} | {centre[2] ^ (1 << a) ^ (1 << 63) for a in range(3, 60)}  # members one bit apart, and two
    values = sorted(values)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    prints = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    edges = simhash.links(prints, bits, Scratch(spark))
    assert all(((a % 2**64) ^ (b % 2**64)).bit_count() <= 2 * bits for a, b in edges.collect())
    found = {r.node: r.root for r in graph.components(edges, Scratch(spark)).collect()}
    groups = collections.defaultdict(set)
    for v in values:
        groups[found.get(signed(v), signed(v))].add(v)
    want = collections.defaultdict(set)
    for v in values:
        want[root(v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates(docs):
    got = {(r.id, r.component_id) for r in simhash.near_duplicates(docs, 3).collect()}
    assert (8, 7) in got and (3, 2) in got and (6, 2) in got and (12, 12) in got and (13, 12) in got


def test_components_of_long_paths(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 150] + [(5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in graph.components(edges, Scratch(spark)).collect()}
    assert got == {i: 0 if i <= 150 else 151 for i in range(n + 1)}
    assert graph.components(edges.limit(0), Scratch(spark)).count() == 0


# 10


def test_contamination(spark, docs, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    w = item.split()
    one, two = [*w[:9], "CHANGED", *w[10:]], [*w[:6], "x", *w[7:13], "y", *w[14:]]
    tests = {1: item.upper(), 2: " ".join(one), 3: "before " * 40 + " ".join(two) + " after" * 40, 4: " ".join(w[:10]), 5: " ".join(w[3:16]), 6: " ".join(reversed(w)), 7: None, 8: "", 9: LONG + item, 10: " ".join(w[::2])}
    df = spark.createDataFrame([(k, v, "own") for k, v in tests.items()] + [(None, item, "own"), (1, item, "own")], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(70, item), (71, "too short an item"), (72, None), (73, item)], "item_id long, text string")
    got = collections.defaultdict(list)
    for r in decontaminate.contaminated(df, bench).collect():
        got[r.row.doc_id].append((r.contaminated, r["items"], r.score))
    hit = {1, 2, 3, 5, 9, None}
    assert {k for k, v in got.items() if all(x[0] for x in v)} == hit
    assert len(got[1]) == 2 and got[1][0] == (True, [70, 73], 20) and got[2][0][2] == 17 and got[3][0][2] == 14
    assert decontaminate.contaminated(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench).count() == len(DOCS)
    monkey = decontaminate.BLOCK_SEEDS
    try:
        decontaminate.BLOCK_SEEDS = 7
        assert decontaminate.contaminated(df, bench).where("contaminated").count() == 7
    finally:
        decontaminate.BLOCK_SEEDS = monkey


def test_contamination_by_short_items(spark):
    rows = [(1, "so Who wrote\nthe long book then"), (2, "who wrote the book"), (3, "Paris"), (4, None), (5, "a b c d e f g h i j"), (6, "b c d e f g h i j a")]
    items = [(1, "who wrote the long book"), (2, "paris"), (3, "a b c d e f g h i j"), (4, ""), (5, "paris"), (6, "who wrote the long book that nobody has read to its end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: (r["items"], r.score) for r in decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {1: ([1], 5), 2: ([], 0), 3: ([2, 5], 1), 4: ([], 0), 5: ([3], 10), 6: ([], 0)}
