"""Whole programs over raster tables and file trees: masks, strips, differences, resampling, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogrid.functions import local
from orogrid.operators import grid, hull, mosaic, register, relations, resample, stats
from orogrid.plans import check, masks
from orogrid.sources import rasters

#: Bits by name.
BITS = {"edge": local.EDGE, "water": local.WATER, "cloud": local.CLOUD}


def mask_scenes(pixels: DataFrame, sun_elevation: float, res: float = 8.0, version: str = "bitmask", **how) -> DataFrame:
    """(rid, r, c, mask) of scenes (z, m, o) by a mask version of `masks.VERSIONS`."""
    df = grid.densify(pixels)
    work = masks.VERSIONS[version]
    if work is masks.scene_mask:
        return work(df, sun_elevation, res, **how).select(*grid.KEY, "mask")
    if work is masks.mask_8m:
        return work(df, **how).select(*grid.KEY, F.col("mask").cast("int").alias("mask"))
    return work(df, res, **how).select(*grid.KEY, F.col("mask").cast("int").alias("mask"))


def mask_bands(pixels: DataFrame, mask: DataFrame, parts: list[str], fills: dict[str, float | None]) -> DataFrame:
    """Bands with the chosen parts of a mask filled in. A mask of another size is taken by its nearest pixels."""
    bits = sum(BITS[p] for p in parts)
    a, b = grid.extent(pixels), grid.extent(mask).toDF("rid", "m0", "m1", "n0", "n1")
    both = pixels.join(a, "rid").join(b, "rid")
    at = lambda x, x0, x1, y0, y1: (F.col(y0) + F.floor((F.col(x) - F.col(x0)) * (F.col(y1) - F.col(y0) + 1) / (F.col(x1) - F.col(x0) + 1))).cast("int")
    both = both.withColumns({"_mr": at("r", "r0", "r1", "m0", "m1"), "_mc": at("c", "c0", "c1", "n0", "n1")})
    joined = both.join(mask.select("rid", F.col("r").alias("_mr"), F.col("c").alias("_mc"), F.col("mask").alias("_mask")), ["rid", "_mr", "_mc"], "left")
    out = masks.apply_mask(joined.withColumn("_mask", F.coalesce("_mask", F.lit(0))), "_mask", bits, fills)
    return out.select(*pixels.columns)


def difference(fixed: DataFrame, moving: DataFrame, cell: float = 1.0, guess: tuple[float, float, float] | None = None, window: tuple[int, int] | None = None) -> tuple[DataFrame, register.Registration]:
    """(rid, r, c, dz) of two strips after registration, and the registration; window: size of the part with most data to fit on."""
    ref, mov = fixed, moving
    if window:
        both = fixed.select(*grid.KEY, F.col("z").alias("_a")).join(moving.select(*grid.KEY, F.col("z").alias("_b")), list(grid.KEY))
        best = resample.best_window(grid.densify(both), F.col("_a").isNotNull() & F.col("_b").isNotNull(), *window, max(1, min(window) // 2)).first()
        cut = lambda df: df.where(F.col("r").between(best.r, best.r + window[0] - 1) & F.col("c").between(best.c, best.c + window[1] - 1))
        ref, mov = cut(fixed), cut(moving)
    found = register.register(grid.densify(ref), grid.densify(mov), cell, guess)
    if found.offset is None:
        raise ValueError("the grids do not overlap enough to be registered")
    moved = register.shifted(grid.densify(moving), found.offset, cell)
    out = moved.join(fixed.select(*grid.KEY, F.col("z").alias("_ref")), list(grid.KEY)).select(*grid.KEY, (F.col("z") - F.col("_ref")).alias("dz"))
    return out, found


def build_strips(scenes: DataFrame, cell: float = 1.0, **how) -> list[mosaic.Segment]:
    """Segments of one strip's scenes (scene, r, c, z, m, o, md), in the order that their rectangles give."""
    boxes = scenes.where("z is not null").groupBy("scene").agg(F.min("c"), -F.max("r"), F.max("c") + 1, 1 - F.min("r")).collect()  # a row for each scene
    order, _ = mosaic.order_scenes(sorted(tuple(b) for b in boxes))
    return mosaic.build_segments(scenes, order, cell, **how)


def resample_bands(pixels: DataFrame, bands: dict[str, str], factor: float) -> DataFrame:
    """Bands at another resolution, each by the method of its kind."""
    return masks.at_resolution(pixels, {c: rasters.BANDS[b][2] for c, b in bands.items()}, factor)


def browse(pixels: DataFrame, factor: float, bits: int = 7) -> DataFrame:
    """Reduced heights, matches, masks and shaded relief, plain and masked, for a quick look."""
    from orogrid.operators import focal

    small = grid.densify(masks.at_resolution(pixels, {"z": "bilinear", "m": "nearest", "o": "bicubic", "mask": "nearest"}, factor))
    shaded = focal.hillshade(small, "z", z=3.0)
    hit = F.coalesce(F.col("mask").cast("int").bitwiseAND(bits) > 0, F.lit(False))
    return shaded.withColumns({"z_masked": F.when(~hit, F.col("z")), "shade_masked": F.when(~hit, F.col("shade"))})


def check_tree(spark: SparkSession, path: str, profile: str) -> DataFrame:
    """(grp, part) that file groups below a folder lack."""
    return check.missing(rasters.listing(spark, path).select("fname"), profile)


def footprints(pixels: DataFrame, **how) -> DataFrame:
    return hull.footprint(pixels, F.col("z").isNotNull(), **how)


def strip_report(pixels: DataFrame, pixel_area: float, footprint_area: float) -> DataFrame:
    return stats.coverage(pixels, "z", "m", "mask", pixel_area, footprint_area)


def bundles(tasks: DataFrame, order: list[str], per_task: int) -> DataFrame:
    return relations.numbered(tasks, order, per_task)
