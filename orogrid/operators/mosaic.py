"""Mosaics of overlapping grids: order, overlap, feather weights, blending, segments."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orogrid.functions import local
from orogrid.operators import focal, grid, hull, register, resample, zonal
from orogrid.plans.scratch import Rounds


def _shared(a, b) -> float:
    return max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))


def order_scenes(rects: list[tuple[str, float, float, float, float]]) -> tuple[list[str], list[str]]:
    """Names by greatest overlap with what is placed so far, and by direction. rects: (name, x0, y0, x1, y1).

    The direction is that of the longer side of all scenes together; the start is the first scene in
    it that shares under 0.9 of its area with any other. Placing stops where nothing overlaps. The
    list is one strip's scenes, a few dozen; ties go to the earlier name."""
    box = {n: tuple(r) for n, *r in rects}
    names = [n for n, *_ in rects]
    width = max(b[2] for b in box.values()) - min(b[0] for b in box.values())
    height = max(b[3] for b in box.values()) - min(b[1] for b in box.values())
    along = sorted(names, key=lambda n: (box[n][0 if width >= height else 1], n))
    first = along[0]
    for n in along if len(names) > 1 else []:
        area = (box[n][2] - box[n][0]) * (box[n][3] - box[n][1])
        if max(_shared(box[n], box[m]) for m in names if m != n) < 0.9 * area:
            first = n
            break
    placed, rest, around = [first], [n for n in names if n != first], box[first]
    while rest:
        nxt = max(rest, key=lambda n: _shared(around, box[n]))
        if _shared(around, box[nxt]) <= 0:
            break
        placed.append(nxt)
        rest.remove(nxt)
        b = box[nxt]
        around = (min(around[0], b[0]), min(around[1], b[1]), max(around[2], b[2]), max(around[3], b[3]))
    return placed, along


def overlap_classes(strip: DataFrame, scene: DataFrame, least: int = 1000) -> DataFrame:
    """(rid, r, c, a): 0 where both have heights or none, 1 where only the scene has, 2 where only the strip has; small clusters count as 0."""
    both = strip.select(*grid.KEY, F.col("z").alias("_s")).join(scene.select(*grid.KEY, F.col("z").alias("_n")), list(grid.KEY), "full")
    both = both.withColumns({"_one": F.col("_s").isNull() & F.col("_n").isNotNull(), "_two": F.col("_s").isNotNull() & F.col("_n").isNull()})
    both = zonal.area_open(zonal.area_open(both, "_one", least), "_two", least)
    return both.select(*grid.KEY, F.when(F.col("_one"), 1).when(F.col("_two"), 2).otherwise(0).alias("a"))


def feather_weights(classes: DataFrame, coarse: float = 0.1) -> DataFrame:
    """(rid, r, c, w): weight of the strip, from 0 at the scene's own side to 1 at the strip's own side.

    The classes are thinned to `coarse` of their size; gaps are filled linearly between the boundary
    pixels of both sides, outside their hull from the nearest pixel and then smoothed; the surface is
    stretched back, and the ramp keeps more of the strip."""
    small = resample.resize(classes, "a", coarse, method="nearest")
    filled = hull.fill_gaps(small)
    smooth = focal.moving_average(filled, "a", 5, "_m", zero_border=False)
    smooth = smooth.select(*grid.KEY, F.when(F.col("outer"), F.coalesce("_m", "a")).otherwise(F.col("a")).alias("a"))
    box = classes.agg(F.max("r") - F.min("r") + 1, F.max("c") - F.min("c") + 1).first()
    full = resample.resize(smooth, "a", shape=(box[0], box[1]), method="bilinear", out="_w")
    low = classes.groupBy("rid").agg(F.min("r").alias("_r0"), F.min("c").alias("_c0"))
    full = full.join(low, "rid").select("rid", (F.col("r") + F.col("_r0")).alias("r"), (F.col("c") + F.col("_c0")).alias("c"), "_w")
    got = classes.join(full, list(grid.KEY), "left")
    w = F.when(F.col("a") == 1, 1.0).when(F.col("a") == 2, 2.0).otherwise(F.coalesce("_w", F.lit(1.0))) - 1
    return got.select(*grid.KEY, local.ramp(F.least(F.greatest(w, F.lit(0.0)), F.lit(1.0))).alias("w"))


def merge(strip: DataFrame, scene: DataFrame, weights: DataFrame, cut: int = 13) -> DataFrame:
    """One grid of both: heights and intensities blended by weight, matches and masks joined by or.

    strip and scene: (rid, r, c, z, m, o, md), md null where there is none. Data of the strip at
    weight 0, and of the scene at weight 1, go; at the cut the data of each side is eroded by `cut`
    pixels where the other has data too, so that edges do not show."""
    s = strip.select(*grid.KEY, *[F.col(c).alias(f"s_{c}") for c in ("z", "m", "o", "md")])
    n = scene.select(*grid.KEY, *[F.col(c).alias(f"n_{c}") for c in ("z", "m", "o", "md")])
    both = s.join(n, list(grid.KEY), "full").join(weights, list(grid.KEY), "left")
    w = F.coalesce("w", F.when(F.col("s_z").isNotNull(), 1.0).otherwise(0.0))
    both = both.withColumn("w", w)
    both = both.withColumns({"_sk": ((F.col("w") > 0) & F.col("s_z").isNotNull()).cast("int"), "_nk": ((F.col("w") < 1) & F.col("n_z").isNotNull()).cast("int")})
    both = focal.erode(focal.erode(both, "_sk", cut, "_se"), "_nk", cut, "_ne")
    keep_s = (F.col("_sk") == 1) & ((F.col("_se") == 1) | (F.col("_nk") == 0))
    keep_n = (F.col("_nk") == 1) & ((F.col("_ne") == 1) | (F.col("_sk") == 0))
    sz, nz = F.when(keep_s, F.col("s_z")), F.when(keep_n, F.col("n_z"))
    return both.select(
        *grid.KEY,
        local.quantize(local.blend(sz, nz, F.col("w"))).alias("z"),
        F.greatest(F.coalesce(F.when(sz.isNotNull(), F.col("s_m")), F.lit(0)), F.coalesce(F.when(nz.isNotNull(), F.col("n_m")), F.lit(0))).alias("m"),
        local.blend(F.col("s_o").cast("double"), F.col("n_o").cast("double"), F.col("w")).alias("o"),
        F.coalesce("s_md", F.lit(0)).bitwiseOR(F.coalesce("n_md", F.lit(0))).alias("md"),
    )


@dataclass
class Segment:
    """pixels, and a row for each scene: (scene, rmse, dz, dx, dy, state, dz_err, dx_err, dy_err)."""

    pixels: DataFrame
    alignment: list[tuple] = field(default_factory=list)


def move_scene(scene: DataFrame, offset: tuple[float, float, float], cell: float, rim: int = 6) -> DataFrame:
    """The scene (rid, r, c, z, m, o, md) by a registration (dz, dx, dy): heights linearly, intensities by cubic
    convolution, matches and masks from the nearest pixel. Rims of heights and of intensities, on which pixels
    without data bear, are eroded by `rim` pixels; matches go with the heights, masks are 0 where there is none."""
    dense = grid.densify(scene)
    dr, dc = -offset[2] / cell, offset[1] / cell
    out = register.shifted(dense.select(*grid.KEY, "z"), offset, cell)
    for band, method in (("m", "nearest"), ("o", "bicubic"), ("md", "nearest")):
        value = F.col(band) if band != "o" else F.when(F.col("o") != 0, F.col("o").cast("double"))
        out = out.join(resample.shift(dense.select(*grid.KEY, value.alias(band)), band, dr, dc, method), list(grid.KEY), "left")
    for band in ("z", "o"):
        out = focal.erode(out.withColumn(f"_{band}", F.col(band).isNotNull().cast("int")), f"_{band}", rim)
    z, o = F.col("_z") > 0, F.col("_o") > 0
    return out.select(
        *grid.KEY, F.when(z, F.col("z")).alias("z"), F.when(z, F.coalesce(F.col("m"), F.lit(0))).otherwise(0).cast("int").alias("m"),
        F.when(o, F.col("o")).alias("o"), F.coalesce(F.col("md"), F.lit(0)).cast("int").alias("md"),
    )


def build_segments(scenes: DataFrame, order: list[str], cell: float = 1.0, rmse_cutoff: float = 3.5, least_new: int = 50_000, least_overlap: int = 1000, rim: int = 6) -> list[Segment]:
    """Strip segments of the scenes (scene, r, c, z, m, o, md on one pixel grid) in the given order.

    A scene with fewer than least_new unmasked pixels, or that adds fewer, is skipped; one that
    overlaps too little or whose registration fails or exceeds the cutoff begins the next segment.
    Each step writes its grid, so a lost executor costs one step; the last one of every segment stays.
    Segments of different strips are independent jobs."""
    keep = Rounds(scenes.sparkSession)
    segments: list[Segment] = []
    current: DataFrame | None = None
    rows: list[tuple] = []
    for name in order:
        scene = scenes.where(F.col("scene") == name).select(F.lit(0).alias("rid"), "r", "c", "z", "m", "o", "md")
        good = scene.where("z is not null and coalesce(md, 0) = 0").count()
        if good < least_new:
            rows.append((name, None, None, None, None, "skipped", None, None, None))
            continue
        if current is not None:
            pair = current.select(*grid.KEY, F.col("z").alias("_a")).join(scene.select(*grid.KEY, F.col("z").alias("_b")), list(grid.KEY), "full")
            told = pair.agg(F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()), F.count_if(F.col("_a").isNull() & F.col("_b").isNotNull())).first()
            if told[1] < least_new:
                rows.append((name, None, None, None, None, "redundant", None, None, None))
                continue
            done = None
            if told[0] >= least_overlap:
                done = register.register(grid.densify(current.select(*grid.KEY, "z")), grid.densify(scene.select(*grid.KEY, "z")), cell)
            if done is None or done.offset is None or done.rmse > rmse_cutoff:
                segments.append(Segment(current, rows))
                current, rows = None, []
                keep = Rounds(scenes.sparkSession)  # the tables of this segment are not the next one's to remove
            else:
                scene = move_scene(scene, done.offset, cell, rim)
                weights = feather_weights(grid.densify(overlap_classes(current, scene, least_overlap)).fillna(0, ["a"]))
                current = keep.keep(grid.densify(merge(grid.densify(current), scene, weights)))
                rows.append((name, done.rmse, *done.offset, "merged", *(done.error or (None, None, None))))
                continue
        current = keep.keep(grid.densify(scene))
        rows.append((name, 0.0, 0.0, 0.0, 0.0, "first", 0.0, 0.0, 0.0))
    if current is not None:
        segments.append(Segment(current, rows))
    return segments
