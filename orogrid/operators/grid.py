"""Pixel tables: one row for each pixel, (rid, r, c, value columns). Nodata is null, and such pixels still have a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("rid", "r", "c")


def along_row():
    return Window.partitionBy("rid", "r").orderBy("c")


def along_column():
    return Window.partitionBy("rid", "c").orderBy("r")


def extent(df: DataFrame) -> DataFrame:
    """First and last row and column of each raster."""
    return df.groupBy("rid").agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"))


def densify(df: DataFrame) -> DataFrame:
    """df with a row for every pixel of the bounding rectangle; new ones have nulls. Windows need this."""
    rows = extent(df).select("rid", F.explode(F.sequence("r0", "r1")).alias("r"), "c0", "c1")
    return rows.select("rid", "r", F.explode(F.sequence("c0", "c1")).alias("c")).join(df, list(KEY), "left")


def with_position(df: DataFrame) -> DataFrame:
    """df with the extent of its raster (r0, r1, c0, c1), a table of one row for each raster."""
    return df.join(extent(df), "rid")


def is_border(width: int = 1) -> Column:
    return (F.col("r") - F.col("r0") < width) | (F.col("r1") - F.col("r") < width) | (F.col("c") - F.col("c0") < width) | (F.col("c1") - F.col("c") < width)


def crop(df: DataFrame, data: Column, buffer: int = 0) -> DataFrame:
    """The pixels within buffer of the bounding rectangle of those with data."""
    box = extent(df.where(data))
    near = F.col("r").between(F.col("r0") - buffer, F.col("r1") + buffer) & F.col("c").between(F.col("c0") - buffer, F.col("c1") + buffer)
    return df.join(box, "rid").where(near).drop("r0", "r1", "c0", "c1")


def window(df: DataFrame, r: int, c: int, height: int, width: int) -> DataFrame:
    """The pixels around (r, c): half the size on each side, the middle of an even size being its lower right one."""
    return df.where(F.col("r").between(r - height // 2, r + (height - 1) // 2) & F.col("c").between(c - width // 2, c + (width - 1) // 2))


def expand(df: DataFrame, r0: int, r1: int, c0: int, c1: int, defaults: dict[str, object]) -> DataFrame:
    """Grown (or kept) to the given rows and columns; new pixels have the defaults."""
    frame = df.select("rid").distinct().select("rid", F.explode(F.sequence(F.lit(r0), F.lit(r1))).alias("r")).select("rid", "r", F.explode(F.sequence(F.lit(c0), F.lit(c1))).alias("c"))
    joined = frame.join(df.withColumn("_own", F.lit(True)), list(KEY), "left")
    return joined.select(*KEY, *[F.when(F.col("_own"), F.col(n)).otherwise(F.lit(v)).alias(n) for n, v in defaults.items()])
