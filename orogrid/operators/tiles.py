"""Tile tables: (rid, tr, tc, h, w, data) with square blocks of pixels as arrays, for large kernels and large rasters.

Each tile sends only its rims to its eight neighbours, so a shuffle moves the pixels once and the rims
again; numpy then works on whole blocks. NaN is nodata inside blocks and null outside of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = "rid {rid}, tr int, tc int, h int, w int, data binary"


def _schema(df: DataFrame) -> str:
    return TILE.format(rid=df.schema["rid"].dataType.simpleString())


def to_tiles(df: DataFrame, value: str, size: int = 512) -> DataFrame:
    """Tiles of a pixel table; missing pixels are nodata. Rows and columns count from 0."""
    cells = df.select("rid", F.floor(F.col("r") / size).cast("int").alias("tr"), F.floor(F.col("c") / size).cast("int").alias("tc"), (F.col("r") % size).alias("i"), (F.col("c") % size).alias("j"), F.col(value).cast("double").alias("v"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = np.full((pdf.i.max() + 1, pdf.j.max() + 1), np.nan)
        block[pdf.i, pdf.j] = pdf.v
        return pd.DataFrame({"rid": [pdf.rid.iloc[0]], "tr": [pdf.tr.iloc[0]], "tc": [pdf.tc.iloc[0]], "h": [block.shape[0]], "w": [block.shape[1]], "data": [block.tobytes()]})

    return cells.groupBy("rid", "tr", "tc").applyInPandas(run, _schema(df)).withMetadata("data", {"size": size})


def _size(tiles: DataFrame) -> int:
    return tiles.schema["data"].metadata["size"]


def to_pixels(tiles: DataFrame, value: str = "v") -> DataFrame:
    size, kind = _size(tiles), tiles.schema["rid"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for t in pdf.itertuples():
                block = np.frombuffer(t.data).reshape(t.h, t.w)
                i, j = np.indices(block.shape)
                v = pd.Series(block.ravel())
                yield pd.DataFrame({"rid": t.rid, "r": (i + t.tr * size).ravel().astype("int32"), "c": (j + t.tc * size).ravel().astype("int32"), value: v.where(v.notna(), None)})

    return tiles.mapInPandas(run, f"rid {kind}, r int, c int, {value} double")


def with_halo(tiles: DataFrame, k: int, work: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """work applied to each tile with k pixels of its neighbours around it (NaN outside the raster); the middle part stays."""
    size = _size(tiles)
    if k > size:
        raise ValueError(f"a kernel that reaches {k} pixels needs tiles of that size")
    kind = tiles.schema["rid"].dataType.simpleString()

    def rims(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t in pdf.itertuples():
                block = np.frombuffer(t.data).reshape(t.h, t.w)
                for dr in (-1, 0, 1):
                    for dc in (-1, 0, 1):
                        rows = slice(None) if dr == 0 else slice(0, k) if dr < 0 else slice(max(0, t.h - k), None)
                        cols = slice(None) if dc == 0 else slice(0, k) if dc < 0 else slice(max(0, t.w - k), None)
                        part = np.ascontiguousarray(block[rows, cols])
                        out.append((t.rid, t.tr + dr, t.tc + dc, dr, dc, part.shape[0], part.shape[1], part.tobytes()))
            yield pd.DataFrame(out, columns=["rid", "tr", "tc", "dr", "dc", "h", "w", "data"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {(t.dr, t.dc): np.frombuffer(t.data).reshape(t.h, t.w) for t in pdf.itertuples()}
        empty = pd.DataFrame({"rid": [], "tr": [], "tc": [], "h": [], "w": [], "data": []})
        if (0, 0) not in parts:
            return empty
        own = parts[0, 0]
        h, w = own.shape
        wide = np.full((h + 2 * k, w + 2 * k), np.nan)
        wide[k : k + h, k : k + w] = own
        for (dr, dc), p in parts.items():
            if (dr, dc) != (0, 0):  # a part sent down (dr = 1) lies above
                r = k - p.shape[0] if dr == 1 else k + h if dr == -1 else k
                c = k - p.shape[1] if dc == 1 else k + w if dc == -1 else k
                wide[r : r + p.shape[0], c : c + p.shape[1]] = p[: wide.shape[0] - r, : wide.shape[1] - c]
        out = work(wide)[k : k + h, k : k + w]
        return pd.DataFrame({"rid": [pdf.rid.iloc[0]], "tr": [pdf.tr.iloc[0]], "tc": [pdf.tc.iloc[0]], "h": [h], "w": [w], "data": [np.ascontiguousarray(out, float).tobytes()]})

    sent = tiles.mapInPandas(rims, f"rid {kind}, tr int, tc int, dr int, dc int, h int, w int, data binary")
    return sent.groupBy("rid", "tr", "tc").applyInPandas(run, _schema(tiles)).withMetadata("data", {"size": size})


def _running(x: np.ndarray, k: int, axis: int, best) -> np.ndarray:
    """best over k neighbours along an axis, in about log2(k) steps of doubled reach."""
    x = np.moveaxis(x, axis, 0)
    lo, hi = k // 2, (k - 1) // 2
    pad = np.full((1, *x.shape[1:]), np.nan)
    x = np.concatenate([np.repeat(pad, lo, 0), x, np.repeat(pad, hi, 0)])
    have = 1
    while have < k:
        step = min(have, k - have)
        x = best(x[:-step], x[step:])
        have += step
    return np.moveaxis(x, 0, axis)


def morph(tiles: DataFrame, k: int, how: str = "max") -> DataFrame:
    """Dilation (max) or erosion (min) by a k x k square; nodata is passed over."""
    best = np.fmax if how == "max" else np.fmin
    return with_halo(tiles, k // 2, lambda x: _running(_running(x, k, 0, best), k, 1, best))


def box_mean(tiles: DataFrame, k: int) -> DataFrame:
    """Sum over k x k pixels by k * k: pixels outside count as 0; nodata gives nodata around it. Within the raster only NaN is nodata."""
    lo, hi = k // 2, (k - 1) // 2

    def sums(x: np.ndarray) -> np.ndarray:
        p = np.pad(x, ((lo + 1, hi), (lo + 1, hi))).cumsum(0).cumsum(1)
        return p[k:, k:] - p[:-k, k:] - p[k:, :-k] + p[:-k, :-k]

    return with_halo(tiles, k // 2, lambda x: sums(np.nan_to_num(x)) / (k * k))
