"""Resampling: pixels are pulled from computed taps, joined by equal keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orogrid.operators import grid


def weights(method: str, t: Column) -> list[tuple[int, Column]]:
    """(offset, weight) of the taps along one axis for a fraction t past the base pixel."""
    if method == "bilinear":
        return [(0, 1 - t), (1, t)]
    if method == "bicubic":
        a = -0.75  # fixed value: sharpness of the cubic

        def near(d: Column) -> Column:
            return ((a + 2) * d - (a + 3)) * d * d + 1

        def far(d: Column) -> Column:
            return ((a * d - 5 * a) * d + 8 * a) * d - 4 * a

        return [(-1, far(t + 1)), (0, near(t)), (1, near(1 - t)), (2, far(2 - t))]
    if method == "lanczos":

        def kernel(d: Column) -> Column:
            x = d * math.pi
            return F.when(F.abs(d) < 1e-9, F.lit(1.0)).otherwise(4 * F.sin(x) * F.sin(x / 4) / (x * x))

        raw = [(k, kernel(t - k)) for k in range(-3, 5)]
        total = sum((w for _, w in raw), F.lit(0.0))
        return [(k, w / total) for k, w in raw]
    raise ValueError(method)


def _frame(df: DataFrame, rows: Column, cols: Column) -> DataFrame:
    """A row for each pixel of the new grid of each raster, with the old extent."""
    out = grid.extent(df).select("*", rows.alias("_rows"), cols.alias("_cols"))
    out = out.select("*", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("nr"))
    return out.select("*", F.explode(F.sequence(F.lit(0), F.col("_cols") - 1)).alias("nc"))


def _pull(frame: DataFrame, df: DataFrame, value: str, sr: Column, sc: Column, method: str, out: str, outside: bool) -> DataFrame:
    """The value at source position (sr, sc), weighted from taps; taps past the border are the outer pixels. A null tap with a
    weight gives null. outside: null for positions beyond the source."""
    frame = frame.withColumns({"_sr": sr, "_sc": sc})
    src = df.select("rid", F.col("r").alias("_r"), F.col("c").alias("_c"), F.col(value).alias("_v"))
    lim = lambda x, a, b: F.least(F.greatest(x, F.col(a)), F.col(b)).cast("int")
    if method == "nearest":
        taps = frame.withColumns({"_r": lim(F.floor(F.col("_sr") + 0.5), "r0", "r1"), "_c": lim(F.floor(F.col("_sc") + 0.5), "c0", "c1")})
        got = taps.join(src, ["rid", "_r", "_c"], "left").withColumn(out, F.col("_v"))
    else:
        frame = frame.withColumns({"_fr": F.col("_sr") - F.floor("_sr"), "_fc": F.col("_sc") - F.floor("_sc")})
        along = {t: F.array(*[F.struct(F.lit(k).alias("k"), w.alias("w")) for k, w in weights(method, F.col(t))]) for t in ("_fr", "_fc")}
        taps = frame.withColumn("_i", F.explode(along["_fr"])).withColumn("_j", F.explode(along["_fc"])).withColumn("_w", F.col("_i.w") * F.col("_j.w"))
        taps = taps.withColumns({"_r": lim(F.floor("_sr") + F.col("_i.k"), "r0", "r1"), "_c": lim(F.floor("_sc") + F.col("_j.k"), "c0", "c1")}).where("_w <> 0")
        keep = [c for c in frame.columns if c not in ("rid", "_fr", "_fc")]
        got = taps.join(src, ["rid", "_r", "_c"], "left").groupBy("rid", *keep).agg(F.when(F.count_if(F.col("_v").isNull()) == 0, F.sum(F.col("_v") * F.col("_w"))).alias(out))
    if outside:
        ok = F.col("_sr").between(F.col("r0"), F.col("r1")) & F.col("_sc").between(F.col("c0"), F.col("c1"))
        got = got.withColumn(out, F.when(ok, F.col(out)))
    return got


def resize(df: DataFrame, value: str, factor: float | None = None, shape: tuple[int, int] | None = None, method: str = "bilinear", out: str | None = None, whole: bool = False) -> DataFrame:
    """(rid, r, c, out) at ceil(factor * size) or the given shape. nearest takes floor(i * old / new); area is the mean of the
    pixels that a new one covers; others put pixel middles over one another. whole: rounded, for integer rasters."""
    out = out or value
    old_r, old_c = F.col("r1") - F.col("r0") + 1, F.col("c1") - F.col("c0") + 1
    rows = F.lit(shape[0]) if shape else F.ceil(old_r * F.lit(factor)).cast("int")
    cols = F.lit(shape[1]) if shape else F.ceil(old_c * F.lit(factor)).cast("int")
    if method == "area":
        return _area(df, value, rows, cols, out)
    frame = _frame(df, rows, cols)
    if method == "nearest":
        sr, sc = F.col("r0") + F.floor(F.col("nr") * old_r / F.col("_rows")), F.col("c0") + F.floor(F.col("nc") * old_c / F.col("_cols"))
    else:
        sr, sc = F.col("r0") + (F.col("nr") + 0.5) * old_r / F.col("_rows") - 0.5, F.col("c0") + (F.col("nc") + 0.5) * old_c / F.col("_cols") - 0.5
    got = _pull(frame, df, value, sr, sc, method, "_o", False)
    v = F.round("_o", 0) if whole else F.col("_o")
    return got.select("rid", F.col("nr").alias("r"), F.col("nc").alias("c"), v.alias(out))


def _area(df: DataFrame, value: str, rows: Column, cols: Column, out: str) -> DataFrame:
    """Each source pixel adds to the new pixels that it overlaps, by the area shared."""
    box = grid.extent(df).select("*", rows.alias("_rows"), cols.alias("_cols"))

    def shares(at: str, first: str, last: str, n: str) -> Column:
        scale = F.col(n) / (F.col(last) - F.col(first) + 1)
        a, b = (F.col(at) - F.col(first)) * scale, (F.col(at) - F.col(first) + 1) * scale
        # the tiny step keeps b on its pixel where float noise lifts it
        cells = F.sequence(F.floor(a + 1e-9).cast("int"), F.greatest(F.ceil(b - 1e-9).cast("int") - 1, F.floor(a + 1e-9).cast("int")))
        return F.transform(cells, lambda k: F.struct(k.alias("k"), (F.least(b, k + 1) - F.greatest(a, k.cast("double"))).alias("w")))

    moved = df.join(box, "rid").withColumn("_i", F.explode(shares("r", "r0", "r1", "_rows"))).withColumn("_j", F.explode(shares("c", "c0", "c1", "_cols")))
    w = F.col("_i.w") * F.col("_j.w")
    got = moved.groupBy("rid", F.col("_i.k").alias("r"), F.col("_j.k").alias("c")).agg(F.when(F.count_if(F.col(value).isNull()) == 0, F.sum(w * F.col(value)) / F.sum(w)).alias(out))
    return got


def shift(df: DataFrame, value: str, dr: float, dc: float, method: str = "bilinear", out: str | None = None) -> DataFrame:
    """The raster sampled at (r + dr, c + dc) for each of its own pixels; null beyond it. Whole shifts are one equi-join."""
    out = out or value
    ir, ic = math.floor(dr), math.floor(dc)
    fr, fc = dr - ir, dc - ic
    own = df.select(*grid.KEY)
    if method == "nearest":
        ir, ic, fr, fc = math.floor(dr + 0.5), math.floor(dc + 0.5), 0.0, 0.0
        method = "bilinear"
    taps = [(i, j, wi, wj) for i, wi in _plain_weights(method, fr) for j, wj in _plain_weights(method, fc) if wi * wj]
    steps = F.array(*[F.struct(F.lit(-(ir + i)).alias("dr"), F.lit(-(ic + j)).alias("dc"), F.lit(float(wi * wj)).alias("w")) for i, j, wi, wj in taps])
    moved = df.select("rid", "r", "c", F.col(value).alias("_v"), F.explode(steps).alias("_t"))
    moved = moved.select("rid", (F.col("r") + F.col("_t.dr")).alias("r"), (F.col("c") + F.col("_t.dc")).alias("c"), "_v", F.col("_t.w").alias("_w"))
    got = moved.groupBy(*grid.KEY).agg(F.when((F.count("*") == len(taps)) & (F.count_if(F.col("_v").isNull()) == 0), F.sum(F.col("_v") * F.col("_w"))).alias(out))
    return own.join(got, list(grid.KEY), "left")


def _plain_weights(method: str, t: float) -> list[tuple[int, float]]:
    if method == "bilinear":
        return [(0, 1 - t), (1, t)]
    if method == "bicubic":
        a = -0.75
        return [(k, ((a + 2) * d - (a + 3)) * d * d + 1 if d <= 1 else ((a * d - 5 * a) * d + 8 * a) * d - 4 * a) for k, d in ((-1, 1 + t), (0, t), (1, 1 - t), (2, 2 - t))]
    raise ValueError(method)


def aligned_bins(df: DataFrame, value: str, x: Column, y: Column, step: float, how: str = "avg", out: str = "v") -> DataFrame:
    """Pixels gathered on a grid whose lines are whole multiples of step: (rid, gx, gy, out, n)."""
    cells = df.withColumns({"gx": F.floor(x / step).cast("int"), "gy": F.floor(y / step).cast("int")})
    agg = {"avg": F.avg, "min": F.min, "max": F.max, "mode": F.mode, "sum": F.sum}[how](value)
    return cells.groupBy("rid", "gx", "gy").agg(agg.alias(out), F.count(value).alias("n"))


def regrid(df: DataFrame, value: str, x0: float, y0: float, dx: float, method: str = "bilinear", out: str | None = None) -> DataFrame:
    """The raster moved onto the grid of whole multiples of dx; columns gx and gy are its indexes there. y falls with r."""
    off_c = math.ceil(x0 / dx) - x0 / dx
    off_r = y0 / dx - math.floor(y0 / dx)
    gx0, gy0 = math.ceil(x0 / dx), math.floor(y0 / dx)
    got = shift(df, value, off_r, off_c, method, out)
    return got.withColumns({"gx": F.col("c") + gx0, "gy": F.lit(gy0) - F.col("r")})


def best_window(df: DataFrame, data: Column, height: int, width: int, step: int) -> DataFrame:
    """(rid, r, c, n): the window of the given size, of those at every step-th place, with most data; the first of equal ones.

    Counts come from prefix sums, so large windows cost as little as small ones."""
    flags = df.withColumn("_f", F.coalesce(data, F.lit(False)).cast("long"))
    flags = flags.withColumn("_p", F.sum("_f").over(grid.along_row().rowsBetween(Window.unboundedPreceding, 0)))
    flags = flags.withColumn("_p", F.sum("_p").over(grid.along_column().rowsBetween(Window.unboundedPreceding, 0)))
    box = grid.extent(df)
    at = box.withColumn("wr", F.explode(F.sequence(F.col("r0"), F.greatest(F.col("r1") - height + 1, F.col("r0")), F.lit(step)))).withColumn("wc", F.explode(F.sequence(F.col("c0"), F.greatest(F.col("c1") - width + 1, F.col("c0")), F.lit(step))))
    ends = [(F.least(F.col("wr") + height - 1, F.col("r1")), F.least(F.col("wc") + width - 1, F.col("c1")), 1), (F.col("wr") - 1, F.least(F.col("wc") + width - 1, F.col("c1")), -1), (F.least(F.col("wr") + height - 1, F.col("r1")), F.col("wc") - 1, -1), (F.col("wr") - 1, F.col("wc") - 1, 1)]
    parts = at.select("rid", "wr", "wc", F.explode(F.array(*[F.struct(a.alias("r"), b.alias("c"), F.lit(s).alias("s")) for a, b, s in ends])).alias("e"))
    parts = parts.select("rid", "wr", "wc", "e.r", "e.c", "e.s").join(flags.select(*grid.KEY, "_p"), list(grid.KEY), "left")
    counts = parts.groupBy("rid", "wr", "wc").agg(F.sum(F.col("s") * F.coalesce("_p", F.lit(0))).alias("n"))
    best = counts.groupBy("rid").agg(F.max(F.struct("n", (-F.col("wr")).alias("a"), (-F.col("wc")).alias("b"))).alias("x"))
    return best.select("rid", (-F.col("x.a")).alias("r"), (-F.col("x.b")).alias("c"), F.col("x.n").alias("n"))
