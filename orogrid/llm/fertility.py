"""Quality rules: counts on words and lines, and the fertility of public tokenisers with bands by language or script."""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orogrid.llm import _words as W
from orogrid.llm._shared import Scratch

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A vocabulary of pieces with byte fallback, which measures words.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: How the vocabulary's publishers split text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Outer bands: least and most characters per token, least and most characters of words per piece, most share of pieces
#: that fall back on a byte, least token entropy as a share of log2(min(tokens, 1000)). By language, else by script.
BANDS = {
    "en": (1.9, 7.0, 1.2, 7.0, 0.02, 0.42),
    "de": (1.7, 6.5, 1.2, 7.0, 0.03, 0.42),
    "es": (1.55, 6.5, 1.2, 7.0, 0.03, 0.42),
    "fr": (1.55, 6.5, 1.2, 7.0, 0.03, 0.42),
    "latin": (1.3, 7.0, 1.0, 7.0, 0.10, 0.40),
    "greek": (0.4, 4.0, 0.5, 4.0, 0.20, 0.30),
    "cyrillic": (0.4, 4.0, 0.9, 5.0, 0.10, 0.30),
    "arabic": (0.4, 4.0, 0.5, 4.0, 0.30, 0.30),
    "cjk": (0.3, 3.0, 0.3, 2.0, 0.80, 0.30),
    "other": (0.1, 7.0, 0.1, 7.0, 1.00, 0.20),
}
#: Inner bands, from the corpus: how many scaled median deviations a measure of a text of `FULL` tokens may lie below and
#: above the median of its language (shorter texts: more, as the root of the length), and the least deviation that counts.
AROUND = {"chars_per_token": (5.0, 6.5, 0.02), "chars_per_piece": (5.5, 6.5, 0.02), "byte_share": (None, 8.0, 0.005), "evenness": (2.0, None, 0.02)}
#: Tokens from which the inner bands no longer narrow, and texts that a language must have for its own.
FULL, LEAST_TEXTS = 700, 20
#: Runs without white space are measured in pieces of this many characters at most.
PIECE = 1 << 16

FIELDS = [
    *((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_pieces")),
    *((n, pa.float64()) for n in ("chars_per_token", "chars_per_piece", "byte_share", "token_entropy")),
    ("band", pa.string()), ("base_failed", pa.bool_()), ("in_band", pa.bool_()),
]
_TYPES = {pa.int64(): "long", pa.float64(): "double", pa.string(): "string", pa.bool_(): "boolean"}

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_LEADS = [("latin", 0x41, 0x5B), ("latin", 0x61, 0x7B), ("latin", 0xC3, 0xCE), ("greek", 0xCE, 0xD0), ("cyrillic", 0xD0, 0xD4), ("arabic", 0xD8, 0xDC), ("cjk", 0xE3, 0xEE)]
_SCRIPTS = ["latin", "greek", "cyrillic", "arabic", "cjk", "other"]
_SCRIPT = np.full(256, 6, np.int64)  # 6: says nothing, such as digits and later bytes of a character
_SCRIPT[0xC2:] = 5
for _name, _a, _b in _LEADS:
    _SCRIPT[_a:_b] = _SCRIPTS.index(_name)


@lru_cache(maxsize=4)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _processor(path: str):
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return p, np.array([p.is_byte(i) for i in range(p.get_piece_size())])


def _word_pieces(t: W.Texts, processor, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the words of each text, and those among them that stand for one byte of a character that the vocabulary
    lacks. Each word is cut into pieces once for all its places in these texts; words are at most PIECE characters at a time."""
    _, first, again = np.unique(t.word_hashes(), return_index=True, return_inverse=True)
    words = [t.data[a:b].tobytes().decode() for a, b in zip(t.starts[first].tolist(), t.ends[first].tolist(), strict=True)]
    parts = [[w] if len(w) <= PIECE else [w[i : i + PIECE] for i in range(0, len(w), PIECE)] for w in words]
    ids = processor.encode(list(chain.from_iterable(parts)), num_threads=1) if words else []
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    total = np.append(0, np.cumsum(size))
    back = np.append(0, np.cumsum(byte[np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum()))]))[total]
    cut = np.append(0, np.cumsum([len(x) for x in parts], dtype=np.int64))
    return tuple(_sums(np.diff(x[cut])[again], t.first) for x in (total, back))


def _pieces(text: str):
    """The text in parts of at most PIECE characters, cut before single blanks, where tokens end anyway."""
    at, n = 0, len(text)
    while n - at > PIECE:
        to = at + PIECE
        cut = text.rfind(" ", at + 1, to)
        while cut > at + 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.rfind(" ", at + 1, cut)
        to = cut if cut > at + 1 else to
        yield text[at:to]
        at = to
    yield text[at:]


def _tokens(text: str, encoding) -> tuple[int, float]:
    """Tokens, and the entropy of their distribution in bits."""
    if len(text) <= PIECE:
        ids = np.asarray(encoding.encode_ordinary(text), np.int64) if len(text) < 64 else encoding.encode_to_numpy(text, disallowed_special=())
        counts = np.unique(ids, return_counts=True)[1]
    else:  # counted piece by piece, so that only the counts of a very long text are held
        counts = np.zeros(encoding.n_vocab, np.int64)
        for piece in _pieces(text):
            counts += np.bincount(encoding.encode_to_numpy(piece, disallowed_special=()), minlength=len(counts))
        counts = counts[counts > 0]
    n = int(counts.sum())
    p = counts / max(1, n)
    return n, float(-(p * np.log2(p)).sum()) + 0.0


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _base(t: W.Texts) -> dict[str, np.ndarray]:
    docs, doc = len(t.counts), t.doc_of_word()
    points = (t.data & 0xC0) != 0x80
    # lines
    stops = np.flatnonzero(t.data == 0x0A)
    edges = np.unique(np.concatenate([t.bounds[:-1][np.diff(t.bounds) > 0], stops + 1, [len(t.data)]]))
    begin, end = edges[:-1], edges[1:].copy()
    end[t.data[end - 1] == 0x0A] -= 1
    wordy = np.searchsorted(t.starts, end) > np.searchsorted(t.starts, begin)
    begin, end = begin[wordy], end[wordy]
    line_doc = np.searchsorted(t.bounds, begin, "right") - 1
    repeated = np.zeros(docs, np.int64)
    if len(begin):
        lines = np.stack([line_doc.astype(np.uint64), W.spans_hash(W._BYTE[t.data], begin, end)])
        order = np.lexsort(lines)
        same = (lines[:, order[1:]] == lines[:, order[:-1]]).all(axis=0)
        repeated = np.bincount(line_doc[order[1:]][same], minlength=docs)
    # windows of five words
    covered = np.zeros(len(doc) + 1, np.int64)
    if len(doc) >= 5:
        at = np.arange(len(doc) - 4)
        at = at[doc[at] == doc[at + 4]]
        grams = np.stack([doc[at].astype(np.uint64), W.spans_hash(t.word_hashes(), at, at + 5)])
        order = np.lexsort(grams)
        same = (grams[:, order[1:]] == grams[:, order[:-1]]).all(axis=0)
        more = np.zeros(len(at), bool)
        more[1:] |= same
        more[:-1] |= same
        again = at[order[more]]
        np.add.at(covered, again, 1)
        np.subtract.at(covered, again + 5, 1)
    script = np.stack([_sums(_SCRIPT[t.data] == k, t.bounds) for k in range(len(_SCRIPTS))], axis=1)
    return {
        "n_words": t.counts, "word_chars": _sums(t.solid & points, t.bounds), "n_symbols": _sums(_SYMBOL[t.data], t.bounds), "n_dup_lines": repeated,
        "n_repeat_words": _sums(np.cumsum(covered[:-1]) > 0, t.first), "script": np.where(script.any(axis=1), script.argmax(axis=1), 5),
    }


def _measure(path: str, pieces: str, bands: dict):
    def run(batches):
        encoding, (processor, byte) = _encoder(path), _processor(pieces)
        for batch in batches:
            rows, langs = batch.column(0), batch.column(2)
            for at, to, t in W.texts(batch.column(1)):
                cols = _base(t)
                script = cols.pop("script")
                tokens = [(len(s), *_tokens(s, encoding)) for s in ((x.as_py() or "") for x in batch.column(1).slice(at, to - at))]
                chars, n, bits = (np.array(x, float) for x in zip(*tokens, strict=True))
                pieces_, back = _word_pieces(t, processor, byte)
                band = [lang if (lang := langs[at + k].as_py()) in bands else _SCRIPTS[script[k]] for k in range(to - at)]
                cpt, cpp, share = chars / np.maximum(n, 1), cols["word_chars"] / np.maximum(pieces_, 1), back / np.maximum(pieces_, 1)
                failed = (cols["n_words"] < 10) | (100 * cols["n_repeat_words"] > 20 * cols["n_words"])
                low, high, least, most, fallback, even = np.array([bands.get(b, bands["other"]) for b in band], float).reshape(-1, 6).T
                fits = (cpt >= low) & (cpt <= high) & (cpp >= least) & (cpp <= most) & (share <= fallback) & (bits >= even * np.log2(np.clip(n, 2, 1000)))
                cols |= {"n_tokens": n.astype(np.int64), "n_pieces": pieces_, "chars_per_token": cpt, "chars_per_piece": cpp, "byte_share": share, "token_entropy": bits, "band": band, "base_failed": failed, "in_band": fits}
                yield pa.RecordBatch.from_arrays([rows.slice(at, to - at), *(pa.array(cols[n], t) for n, t in FIELDS)], ["row", *(n for n, _ in FIELDS)])

    return run


def _inner(measured: DataFrame) -> DataFrame:
    """By band, the exact median and median deviation of each measure over all texts that pass the base rules (values to three digits)."""
    usual = measured.where("not base_failed")
    near = F.broadcast(usual.groupBy("band").agg(F.count("*").alias("texts"), *(F.percentile(F.round(c, 3), 0.5).alias(f"{c}_mid") for c in AROUND)))  # a row for each band: len(bands) at most
    wide = (F.percentile(F.round(F.abs(F.col(c) - F.col(f"{c}_mid")), 3), 0.5).alias(f"{c}_dev") for c in AROUND)
    return near.join(usual.join(near, "band").groupBy("band").agg(*wide), "band")


def assess(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", vocabulary: str = VOCABULARY, pieces: str = PIECES, bands: dict | None = None, keep_text: bool = True) -> DataFrame:
    """(row, measures, base_failed, in_band, kept) of every row; row is a struct of all columns of docs (keep_text: the text, too), so names can't clash.

    One pass over whole texts measures them with two public vocabularies; only a few numbers are then
    shuffled. base_failed: fewer than 10 words, or over 20 % of the words in five-word windows that the
    text repeats. chars_per_token and token_entropy: of the whole text in `vocabulary` (a file of ranks);
    chars_per_piece and byte_share: of its words in `pieces`, which falls back on bytes. Both files are
    read on each executor. in_band: all four within the outer band of the language, or of the script with
    the most letters where the language is null or has no band. kept: not base_failed, in_band, and within
    the inner band that the corpus itself gives for the language (see AROUND; languages of fewer than
    LEAST_TEXTS texts have none). Null and empty texts have no words and fail. Equal rows stay as many. An
    empty table gives an empty one.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if keep_text or c != text_col]).alias("row")
    lang = F.col(lang_col).cast("string") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    data = docs.select(row, F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    schema = f"row {data.schema['row'].dataType.simpleString()}, " + ", ".join(f"{n} {_TYPES[t]}" for n, t in FIELDS)
    measured = data.mapInArrow(_measure(vocabulary, pieces, bands or BANDS), schema)
    measured = measured.withColumn("evenness", F.col("token_entropy") / F.log2(F.least(F.greatest("n_tokens", F.lit(2)), F.lit(1000))))
    measured = Scratch(docs.sparkSession).keep(measured, "measured")
    fits = F.lit(True)
    slack = F.greatest(F.lit(1.0), F.sqrt(F.lit(FULL) / F.greatest("n_tokens", F.lit(1))))
    for c, (below, above, least) in AROUND.items():
        off = (F.col(c) - F.col(f"{c}_mid")) / F.greatest(F.col(f"{c}_dev") * 1.4826, F.lit(least)) / slack
        fits &= (off >= -below if below else F.lit(True)) & (off <= above if above else F.lit(True))
    unusual = F.col("texts").isNull() | (F.col("texts") < LEAST_TEXTS)
    kept = ~F.col("base_failed") & F.col("in_band") & (unusual | fits)
    return measured.join(F.broadcast(_inner(measured)), "band", "left").select("row", *(n for n, _ in FIELDS), kept.alias("kept"))
