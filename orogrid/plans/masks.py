"""Quality masks of scenes, composed of focal and zonal operators.

All take and return dense pixel tables (rid, r, c, ...); heights z, matches m (0/1), radiance o are
null where there is no data. Every step works on all rasters of the table in one job.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.functions import local
from orogrid.operators import focal, grid, hull, resample, stats, zonal
from orogrid.plans.scratch import Rounds

#: Height spread up to which a sigma counts as cloud, and that sigma.
SIGMA_BY_SPREAD = ((40.0, 10.5), (50.0, 15.0), (75.0, 19.0), (100.0, 27.0), (float("inf"), 50.0))


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def kernel_for(res: float, size: int = 21) -> int:
    """Pixels of a kernel that is `size` pixels wide at two metres."""
    return int(math.floor(size * 2 / res))


def slope_mask(df: DataFrame, res: float = 2.0, k: int | None = None, dilate: int | None = 13, out: str = "slope", dx: float | None = None, dy: float | None = None) -> DataFrame:
    """Set where the mean grade over k x k pixels exceeds 1, grown by `dilate`, or is not known."""
    k = k or min(21, kernel_for(res))
    df = focal.gradient(df, "z", dy or res, dx or res)
    df = focal.moving_average(df.withColumn("_grade", focal.grade()), "_grade", k, "_mean")
    df = df.withColumn("_steep", _flag(F.col("_mean") > 1).cast("int"))
    if dilate:
        df = focal.dilate(df, "_steep", dilate)
    return df.withColumn(out, (F.col("_steep") > 0) | F.col("_mean").isNull()).drop("_steep", "_mean", "_grade", "gx", "gy")


def entropy_mask(df: DataFrame, k: int = 5, thresh: float = 0.2, least: int = 1000, out: str = "flat", rounded: bool = True) -> DataFrame:
    """Set where the texture (range along columns) has little entropy: flat areas, small ones cleaned out; never on background."""
    df = focal.range_along_columns(df, "o", k, "_range")
    df = df.withColumn("_level", local.clip_cast(F.coalesce("_range", F.lit(0.0)), "uint8") if rounded else F.coalesce("_range", F.lit(0)).cast("int"))
    df = focal.entropy(df, "_level", k, "_bits").withColumn(out, _flag(F.col("_bits") < thresh))
    df = zonal.clean_mask(df, out, least, least)
    return df.withColumn(out, F.col(out) & _flag(F.col("o") != 0)).drop("_range", "_level", "_bits")


def water_mask(df: DataFrame, sun_elevation: float, density: str = "density", k: int = 5, least: int = 500, grow: int = 7, out: str = "water") -> DataFrame:
    """Dark areas with few matches, or smooth ones (low entropy, grown); small clusters and gaps cleaned."""
    dark = 5.0 if sun_elevation < 30 else 20.0
    data = _flag(F.col("o") != 0)
    df = focal.range_along_columns(df, "o", k, "_range")
    df = focal.entropy(df.withColumn("_level", local.clip_cast(F.coalesce("_range", F.lit(0.0)), "uint8")), "_level", k, "_bits")
    df = df.withColumn("_smooth", data & _flag(F.col("_bits") < 0.2))
    df = zonal.area_open(df, "_smooth", least)
    df = focal.dilate(df.withColumn("_grown", F.col("_smooth").cast("int")), "_grown", grow)
    df = zonal.area_open(df.withColumn("_dark", data & _flag(F.col("o") < dark) & _flag(F.col(density) < 0.98)), "_dark", least)
    df = df.withColumn("_land", ~(data & ((F.col("_grown") > 0) | F.col("_dark"))))
    df = zonal.clean_mask(df, "_land", least, least)
    return df.withColumn(out, ~F.col("_land")).drop("_range", "_level", "_bits", "_smooth", "_grown", "_dark", "_land")


def cloud_mask(df: DataFrame, density: str = "density", water: str | None = None, edge: str | None = None, k: int = 21, least: int = 1000, erode: int = 31, grow_back: int = 61, grow: int = 21, gap: int = 10_000, out: str = "cloud") -> DataFrame:
    """Bright areas with few matches, areas with hardly any, and rough ones for the height spread of the raster.

    Small clusters and thin rims go, the rest grows and swallows gaps. A raster with under twice
    `least` heights is all set."""
    told = df.groupBy("rid").agg((F.percentile("z", 0.8) - F.percentile("z", 0.2)).alias("_spread"), F.count("z").alias("_data"))
    limit = F.lit(SIGMA_BY_SPREAD[-1][1])
    for most, sigma in reversed(SIGMA_BY_SPREAD[:-1]):
        limit = F.when(F.col("_spread") <= most, sigma).otherwise(limit)
    df = focal.box_deviation(df, "z", k, "_sigma").join(told, "rid")
    data = F.col("z").isNotNull()
    bright = _flag(F.col("o") > 70) & _flag(F.col(density) < 0.9)
    df = df.withColumn("_c", data & (bright | _flag(F.col(density) < 0.6) | _flag(F.col("_sigma") > limit)))
    if water:
        df = df.withColumn("_c", F.col("_c") & ~_flag(F.col(water)))
    df = zonal.area_open(df, "_c", least)
    df = df.withColumn("_t", F.col("_c").cast("int"))
    df = focal.dilate(focal.erode(df, "_t", erode), "_t", grow_back)
    df = df.withColumn("_c", F.col("_c") & (F.col("_t") > 0))
    if edge:
        df = df.withColumn("_c", F.col("_c") & ~_flag(F.col(edge)))
    df = focal.dilate(df.withColumn("_t", F.col("_c").cast("int")), "_t", grow)
    df = zonal.drop_gaps(df.withColumn("_c", F.col("_t") > 0), "_c", gap)
    return df.withColumn(out, F.col("_c") | (F.col("_data") < 2 * least)).drop("_c", "_t", "_spread", "_data", "_sigma")


def edge_mask(df: DataFrame, good: str, res: float | None = None, least: int | None = 1000, concavity: float = 0.5, crop: int | None = None, out: str = "edge") -> DataFrame:
    """What lies outside the concave hull of the good pixels, holes filled and small clusters left out.

    A raster without good pixels, or with none left, has nothing set."""
    least = least if least is not None else int(math.floor(1000 * 2 / (res or 1)))
    df = zonal.fill_holes(df, good, "_in")
    df = Rounds(df.sparkSession).keep(zonal.area_open(df, "_in", least))  # read four times from here
    some = df.groupBy("rid").agg(F.bool_or("_in").alias("_some"))
    df = hull.concave_hull_image(df, "_in", concavity, "_hull")
    if crop:
        df = focal.erode(df.withColumn("_h", F.col("_hull").cast("int")), "_h", crop).withColumn("_hull", F.col("_h") > 0).drop("_h")
    return df.join(some, "rid").withColumn(out, _flag(F.col("_some")) & ~F.col("_hull")).drop("_in", "_hull", "_some")


def good_data_islands(df: DataFrame, mask: str, res: float = 8.0) -> DataFrame:
    """The mask, also set on islands of good data that are small for the resolution."""
    return zonal.drop_gaps(df, mask, int(500 * (8 / res) ** 2))


def scene_mask(df: DataFrame, sun_elevation: float, res: float = 8.0, density_kernel: int | None = None, cloud: dict | None = None, edge_least: int = 1000) -> DataFrame:
    """df (z, m, o) with edge, water, cloud flags and the bit mask of the three: the standard mask at processing resolution."""
    keep = Rounds(df.sparkSession)
    df = focal.data_density(df, F.col("m") > 0, density_kernel or kernel_for(res), "density")
    df = df.withColumns({"density": F.when(F.col("z").isNotNull(), F.col("density")).otherwise(0.0), "o": F.when(F.col("z").isNotNull(), F.col("o")).otherwise(0.0), "none": F.col("z").isNull()})
    df = slope_mask(df, res)
    df = edge_mask(df.withColumn("_good", ~F.col("slope")), "_good", least=edge_least)
    df = keep.keep(zonal.envelope(df, "edge", "none").drop("_good"))
    df = keep.keep(zonal.envelope(water_mask(df, sun_elevation), "water", "none", "edge"))
    df = keep.keep(zonal.envelope(cloud_mask(df, water="water", edge="edge", **(cloud or {})), "cloud", "none", "edge"))
    return df.withColumn("mask", local.bitmask(F.col("edge"), F.col("water"), F.col("cloud")))


def rough_mask(df: DataFrame, res: float = 8.0, k: int = 21, rough: float = 0.75, still: float = 0.1, seed_least: int = 10, grow: int = 11, gap: int = 5000, rim: int = 5, out: str = "mask") -> DataFrame:
    """Mask from the deviation of slopes: rough pixels with missing matches, grown while the surface stays rough."""
    keep = Rounds(df.sparkSession)
    df = focal.gradient(df, "z", res, res)
    df = edge_mask(slope_mask(df.drop("gx", "gy"), res, k).withColumn("_good", ~F.col("slope")), "_good", res=res)
    df = df.withColumn("_z", F.when(~F.col("edge"), F.col("z")))
    df = focal.gradient(df, "_z", res, res)
    gone = F.col("gx").isNull() | F.col("gy").isNull()
    df = focal.box_deviation(df.withColumns({"_x": F.coalesce("gx", F.lit(0.0)), "_y": F.coalesce("gy", F.lit(0.0)), "_gone": gone.cast("int")}), "_x", k, "_sx")
    df = focal.dilate(focal.box_deviation(df, "_y", k, "_sy"), "_gone", k)
    sigma = F.when(F.col("_gone") == 0, F.sqrt(F.col("_sx") * F.col("_sx") + F.col("_sy") * F.col("_sy")))
    df = focal.data_density(df.withColumn("_sigma", sigma), F.col("m") > 0, k, "_density")
    df = df.withColumn(out, _flag(F.col("_sigma") > rough) & _flag(F.col("_density") < 1) & F.col("_z").isNotNull())
    df = keep.keep(zonal.area_open(df, out, seed_least))
    allowed = F.col("_z").isNotNull() & _flag(F.col("_sigma") >= still)
    df = zonal.reconstruct(df.withColumn("_ok", allowed), out, "_ok", grow)
    df = zonal.drop_gaps(df, out, gap)
    df = focal.dilate(df.withColumn("_n", F.col("_z").isNull().cast("int")), "_n", rim)
    df = zonal.drop_gaps(df.withColumn(out, F.col(out) | (F.col("_n") > 0)), out, gap)
    return df.drop("_z", "_x", "_y", "_gone", "_sx", "_sy", "_sigma", "_density", "_ok", "_n", "gx", "gy", "slope", "edge", "_good")


def density_mask(df: DataFrame, res: float, old: bool = False, entropy: bool = False, out: str = "mask") -> DataFrame:
    """The first mask: off the dense matches' concave hull, and inside it where matches are rare."""
    keep = Rounds(df.sparkSession)
    k, p = (kernel_for(res), 0.8) if old else (kernel_for(res, 101), 0.99)
    df = focal.data_density(df, F.col("m") > 0, k, "_d").withColumn("_good", F.col("_d") >= p)
    if entropy:
        df = entropy_mask(df, kernel_for(res if res > 8 else 8.0), out="_flat")
        df = df.withColumn("_good", F.col("_good") | F.col("_flat")).drop("_flat")
    df = keep.keep(edge_mask(keep.keep(df), "_good", res=res, crop=k))
    n, q, small, gap = (kernel_for(res), 0.3, 1000, 10_000) if old else (kernel_for(res, 101), 0.9, 1000, 1000)
    df = focal.data_density(df.withColumn("_m", (F.col("m") > 0) & ~F.col("edge")), F.col("_m"), n, "_d").withColumn("_keep", F.col("_d") >= q)
    df = keep.keep(zonal.area_open(keep.keep(df), "_keep", small))
    df = zonal.drop_gaps(df, "_keep", gap)
    return df.withColumn(out, ~F.col("_keep") | F.col("edge")).drop("_d", "_good", "_m", "_keep", "edge")


def mask_8m(df: DataFrame, out: str = "mask") -> DataFrame:
    """Edge by slope, then areas of mostly usable pixels. A raster without heights has nothing masked."""
    k = 21
    some = df.groupBy("rid").agg((F.count("z") > 0).alias("_some"))
    df = slope_mask(df, 8.0)
    df = edge_mask(df.withColumn("_good", ~F.col("slope")), "_good", least=1000)
    df = df.withColumn("_use", F.col("z").isNotNull() & ~F.col("edge"))
    df = focal.data_density(df, F.col("_use"), k, "_d").withColumn("_use", F.col("_use") & (F.col("_d") >= 0.9))
    df = zonal.area_open(zonal.clean_mask(df, "_use", 1000, 1000), "_use", 500)
    return df.join(some, "rid").withColumn(out, ~F.col("_use") & F.col("_some")).drop("_use", "_d", "_some", "slope", "edge", "_good")


def at_resolution(df: DataFrame, cols: dict[str, str], factor: float) -> DataFrame:
    """The bands resized by factor, each by its method, side by side again."""
    out = None
    for name, method in cols.items():
        band = resample.resize(df, name, factor, method=method)
        out = band if out is None else out.join(band, list(grid.KEY), "full")
    return out


#: Mask names and what makes them; further ones can be added.
VERSIONS = {"maskv1": density_mask, "mask": scene_mask, "bitmask": scene_mask, "mask2a": rough_mask, "mask8m": mask_8m}


def apply_mask(df: DataFrame, mask: str, bits: int, fills: dict[str, float | None], crop_to: str | None = None) -> DataFrame:
    """Bands with the selected mask bits filled in (None: null), optionally cropped to what is left."""
    hit = _flag(F.col(mask).bitwiseAND(bits) > 0)
    df = df.withColumns({b: F.when(~hit, F.col(b)) if v is None else local.filled(F.col(b), hit, v) for b, v in fills.items()})
    return grid.crop(df, F.col(crop_to).isNotNull()) if crop_to else df


def coverage_report(df: DataFrame, mask: str = "mask") -> DataFrame:
    """(rid, mask, n, mean_z): pixels and mean height by mask value."""
    return df.groupBy("rid", mask).agg(F.count("*").alias("n"), F.avg("z").alias("mean_z"))


def spread(df: DataFrame) -> DataFrame:
    return stats.percentile_spread(df, "z")
