"""The pipeline's stages on small tables, each held against brute force on its own input."""

import re

import corpus_pipeline
from orogrid.llm import fertility, simhash

DATA = "/root/testdata/sf0.01"


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        seen.append((name, ids))
        if k < 4:
            assert docs.columns == columns
    assert [n for n, _ in seen] == ["quality", "lines", "near_duplicates", "decontamination", "mixture"]
    assert all(len(a) >= len(b) > 0 for (_, a), (_, b) in zip(seen, seen[1:], strict=False))

    first = spark.read.parquet(f"{DATA}/documents.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").collect()}
    failed = {r.row.doc_id for r in fertility.assess(first).where("base_failed").collect()}
    assert good - failed <= seen[0][1]  # clean documents stay

    texts = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "1")).collect()}
    assert all(len(t) == n for t, n in ((r.text, r.n_chars) for r in spark.read.parquet(str(tmp_path / "1")).collect()))
    sets = {i: shingles(t) for i, t in texts.items()}
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for v in by.values() if len(v) < 50 for a in v for b in v if a < b}
    alike = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    kept = seen[2][1]
    assert sum(a in kept and b in kept for a, b in alike) <= 0.1 * len(alike)
    assert set(texts) - kept <= {b for _, b in alike} | {b for v in by.values() for b in v if len(v) >= 50}

    items = [r.text.lower().split() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + 13]) for w in items for i in range(len(w) - 12)}
    held = {i for i, t in texts.items() if i in kept and (w := t.lower().split()) and any(tuple(w[j : j + 13]) in grams for j in range(len(w) - 12))}
    assert not held & seen[3][1]
    assert seen[4][1] == seen[3][1]
    assert docs.where("taken > 3 * size or taken < 0").count() == 0


def test_similar_documents_in_a_large_group(spark):
    import random

    rng = random.Random(9)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(50)) for _ in range(300)]
    rows = []
    for i in range(150):  # one group far above a bucket
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(300)] = f"new{rng.random()}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"{i}w{j}" for j in range(100))) for i in range(30)] + [(2000, None), (2001, ""), (None, rows[0][1]), (0, rows[0][1])]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    ids = [r.doc_id for r in kept]
    assert sum(i is not None and i < 1000 for i in ids) == 2 and ids.count(0) == 2  # the first one, as often as it is there
    assert {1000 + i for i in range(30)} | {2000, 2001, None} <= set(ids)


def _star(rng, centre_at, variants, words, changed, first):
    """A text and variants of it, all similar to it and to few others: (id, text), the text itself at place centre_at."""
    base = [f"w{first}x{j}" for j in range(words)]
    rows = []
    for i in range(variants + 1):
        w = list(base)
        for c in range(changed if i != centre_at else 0):
            w[rng.randrange(words // changed * c + 2, words // changed * (c + 1) - 2)] = f"new{first + i}x{c}"
        rows.append((first + i, " ".join(w)))
    return rows


def test_groups_do_not_depend_on_the_size_of_buckets(spark, monkeypatch):
    """A bucket that counts as large leaves no pair out: a text that fell is still held against the rest."""
    import random

    rows = _star(random.Random(4), 60, 120, 300, 6, 0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(simhash, "BUCKET", 2)
    monkeypatch.setattr(simhash, "CHUNK", 9000, raising=False)  # several chunks
    assert {r.doc_id for r in simhash.keep_first(df).collect()} == {0}


def test_no_similar_pair_is_missed(spark):
    """Pairs at a similarity of barely 0.8, of many lengths, and a text in the middle of a group of 40."""
    import random

    rng = random.Random(8)
    rows = _star(rng, 20, 39, 300, 6, 0)
    for k in range(200):
        n = rng.randint(9, 120)
        w = [f"p{k}x{j}" for j in range(n)]
        rows += [(1000 + 2 * k, " ".join(w)), (1001 + 2 * k, " ".join(w + [f"q{k}x{j}" for j in range((n - 4) // 4)]))]
    rows += [(i + 5000, f"p{i} a b c {i} d") for i in range(100)]
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    for b in sorted(sets):
        for a in sets:
            if a < b and sets[a] & sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    want = {(i, r) for i, r in root.items() if i != r}
    assert len(want) == 39 + 200
    assert {(r.id, r.first) for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()} == want


def test_rest_works_without_this_package():
    """The raster part neither imports nor names the subpackage."""
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for p in (root / "orogrid").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"orogrid[./]llm|corpus_pipeline", p.read_text()), p


def test_stages_with_odd_tables(spark, tmp_path):
    """Nulls in any column, empty and repeated rows, an empty table, and columns that the stages name themselves."""
    text = "a text of more than ten words that nothing else in this table has, with no line twice"
    rows = [(1, text, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, f"{text} but one", None, "t", 5), (1, text, "en", "s", 1), (4, "x", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("size", "Taken", "target", "row", "score", "documents_size", "key", "id"):
        docs = docs.withColumn(c, docs.lang)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name))
        assert got.count() == {"quality": 3, "lines": 6, "near_duplicates": 6, "decontamination": 6, "mixture": 6}[name] or name == "lines"
        if k < 4:
            assert got.columns == docs.columns
        assert stage(spark, docs.limit(0), DATA).count() == 0
    assert got.columns[-4:] == ["size", "source_size", "target", "taken"] and {"documents_Taken", "documents_target", "documents_documents_size"} <= set(got.columns)
