"""Geotransforms, corners, rectangles and WKT, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def geotransform(x0: Column, dx: Column, y0: Column, dy: Column, rx: Column | None = None, ry: Column | None = None) -> Column:
    """x of a corner, width of a pixel, row rotation, y of the corner, column rotation, (negative) height of a pixel."""
    zero = F.lit(0.0)
    return F.struct(x0.alias("x0"), dx.alias("dx"), (rx if rx is not None else zero).alias("rx"), y0.alias("y0"), (ry if ry is not None else zero).alias("ry"), dy.alias("dy"))


def pixel_xy(gt: Column, r: Column, c: Column) -> tuple[Column, Column]:
    return gt["x0"] + c * gt["dx"] + r * gt["rx"], gt["y0"] + c * gt["ry"] + r * gt["dy"]


def grid_index(value: Column, origin: Column, step: Column) -> Column:
    """Whole index of a coordinate on a grid: joins go by this, never by coordinates."""
    return F.rint((value - origin) / step).cast("int")


def with_resolution(gt: Column, dx: Column, dy: Column) -> Column:
    return geotransform(gt["x0"], dx, gt["y0"], dy, gt["rx"], gt["ry"])


def with_origin(gt: Column, x0: Column, y0: Column) -> Column:
    return geotransform(x0, gt["dx"], y0, gt["dy"], gt["rx"], gt["ry"])


def shape_for(size: Column, extent: Column, step: Column) -> Column:
    """Pixels that a changed step needs for an unchanged extent."""
    return F.ceil(size * extent / F.abs(step)).cast("int")


def corners(gt: Column, rows: Column, cols: Column) -> Column:
    """The five points of the outline, the first again at the end."""
    points = [(F.lit(0), F.lit(0)), (F.lit(0), cols), (rows, cols), (rows, F.lit(0)), (F.lit(0), F.lit(0))]
    xy = [pixel_xy(gt, r, c) for r, c in points]
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in xy])


def to_wkt(points: Column) -> Column:
    text = F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ",")
    return F.concat(F.lit("POLYGON (("), text, F.lit("))"))


def from_wkt(wkt: Column) -> Column:
    number = r"-?\d+(?:\.\d*)?(?:[eE][-+]?\d+)?"
    pairs = F.regexp_extract_all(wkt, F.lit(rf"{number}\s+{number}"), 0)
    return F.transform(pairs, lambda p: F.struct(F.split(p, r"\s+")[0].cast("double").alias("x"), F.split(p, r"\s+")[1].cast("double").alias("y")))


def overlap_area(ax0: Column, ay0: Column, ax1: Column, ay1: Column, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """Area that two rectangles share; 0 if they only touch."""
    zero = F.lit(0.0)
    return F.greatest(F.least(ax1, bx1) - F.greatest(ax0, bx0), zero) * F.greatest(F.least(ay1, by1) - F.greatest(ay0, by0), zero)


def rectangle(points: Column) -> Column:
    """Bounding rectangle of points as a closed ring."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    x0, x1, y0, y1 = F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)
    ring = [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ring])


def allowed_epsg(code: Column) -> Column:
    """Polar stereographic north or south, or a UTM zone on WGS 84."""
    return code.isin(3413, 3031) | code.between(32601, 32660) | code.between(32701, 32760)
