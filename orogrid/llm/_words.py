"""Vectorised word arithmetic on the buffers of Arrow string columns: no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes handled at once, unless one text alone is longer.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """B**j and B**-j modulo 2**64 for an odd B, extended on demand."""

    def __init__(self, base: int):
        self.base, self.n = base, 0
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, CHUNK)
            inverse = pow(self.base, -1, 1 << 64)
            one = np.ones(1, np.uint64)
            self.up = np.multiply.accumulate(np.concatenate([one, np.full(self.n, self.base, np.uint64)]))
            self.down = np.multiply.accumulate(np.concatenate([one, np.full(self.n, inverse, np.uint64)]))
        return self.up, self.down


_POWERS = _Powers(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[s:e], which depend on the content only. values: uint64."""
    up, down = _POWERS.to(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        raw = (total[ends] - total[starts]) * down[starts]
        return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))


class Texts:
    """Some texts laid end to end as UTF-8. bounds: where each begins, and the end. Null texts are empty."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        solid = ~_SPACE[data]
        before = np.zeros(len(data), bool)
        before[1:] = solid[:-1]
        inner = bounds[:-1][bounds[:-1] < len(data)]
        before[inner] = False
        after = np.zeros(len(data), bool)
        after[:-1] = solid[1:]
        after[inner[inner > 0] - 1] = False
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.starts, bounds)  # word number at which each text begins, and the number of words
        self.counts = np.diff(self.first)
        self.solid = solid

    def word_hashes(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            return spans_hash(_BYTE[self.data], self.starts, self.ends)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def chunks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, bounds) in pieces of about CHUNK bytes; every text is whole."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def texts(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    for at, to, data, bounds in chunks(column):
        yield at, to, Texts(data, bounds)


def lowered_words(t: Texts) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words, A-Z lower-cased, with one space between; starts and ends of the words in it."""
    keep = t.solid.copy()
    gap = t.ends[t.ends < len(t.data)]
    if len(t.ends):
        keep[gap] |= ~t.solid[gap]
    out = np.where(t.solid, _LOWER[t.data], np.uint8(0x20))
    place = np.cumsum(keep) - keep
    starts = place[t.starts]
    return out[keep].tobytes(), starts, starts + (t.ends - t.starts)
