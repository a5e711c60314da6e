"""Joins on grids and file lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orogrid.functions import geo
from orogrid.operators import grid
from orogrid.plans.scratch import Rounds


def stack_bands(bands: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    """Bands of equal shape side by side: each a pixel table whose value column is named after it."""
    names = list(bands)
    out = bands[names[0]]
    for n in names[1:]:
        out = out.join(bands[n], list(grid.KEY), how)
    return out


def same_shape(a: DataFrame, b: DataFrame) -> DataFrame:
    """(rid, same): whether two bands of a raster cover the same pixels."""
    x, y = grid.extent(a), grid.extent(b)
    pair = x.alias("x").join(y.alias("y"), "rid", "full")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("r0", "r1", "c0", "c1")]
    return pair.select("rid", (same[0] & same[1] & same[2] & same[3]).alias("same"))


def grid_union(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on whole grid indexes; which of the two is there follows from the nulls."""
    return a.join(b, keys, "full")


def overlapping(rects: DataFrame, key: str, cell: float) -> DataFrame:
    """(a, b, area) of all pairs of rectangles (x0, y0, x1, y1) that share area, a < b.

    Rectangles are dealt to the square cells that they touch, and pairs within a cell compared; a pair
    is kept in the cell of its overlap's lower left corner, so it comes once. No pair without a common
    cell is ever formed."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell))
    dealt = rects.withColumn("_i", F.explode(span("x0", "x1"))).withColumn("_j", F.explode(span("y0", "y1")))
    a, b = dealt.alias("a"), dealt.alias("b")
    both = a.join(b, (F.col("a._i") == F.col("b._i")) & (F.col("a._j") == F.col("b._j")) & (F.col(f"a.{key}") < F.col(f"b.{key}")))
    area = geo.overlap_area(*[F.col(f"a.{c}") for c in ("x0", "y0", "x1", "y1")], *[F.col(f"b.{c}") for c in ("x0", "y0", "x1", "y1")])
    home = (F.floor(F.greatest("a.x0", "b.x0") / cell) == F.col("a._i")) & (F.floor(F.greatest("a.y0", "b.y0") / cell) == F.col("a._j"))
    return both.where(home).select(F.col(f"a.{key}").alias("a"), F.col(f"b.{key}").alias("b"), area.alias("area")).where("area > 0")


def missing_parts(files: DataFrame, group: str, part: str, required: list[str]) -> DataFrame:
    """(group, part) of each required part that a group lacks."""
    wanted = files.select(group).distinct().select(group, F.explode(F.array(*map(F.lit, required))).alias(part))
    return wanted.join(files.select(group, part), [group, part], "left_anti")


def not_in(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys), keys, "left_anti")


def compare_lists(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side): both, left or right, for two lists of files."""
    x, y = a.select(*keys).distinct().withColumn("_a", F.lit(1)), b.select(*keys).distinct().withColumn("_b", F.lit(1))
    side = F.when(F.col("_a").isNull(), "right").when(F.col("_b").isNull(), "left").otherwise("both")
    return x.join(y, keys, "full").select(*keys, side.alias("side"))


def first_by_priority(files: DataFrame, group: str, name: str, suffixes: list[str]) -> DataFrame:
    """(group, name, suffix): of each group the file with the earliest suffix of the list."""
    ranked = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("s")) for k, s in enumerate(suffixes)])
    hit = F.get(F.filter(ranked, lambda x: F.endswith(F.col(name), x["s"])), 0)
    found = files.withColumn("_h", hit).where("_h is not null")
    best = found.groupBy(group).agg(F.min(F.struct("_h.k", name, F.col("_h.s").alias("suffix"))).alias("x"))
    return best.select(group, F.col(f"x.{name}").alias(name), "x.suffix")


def common_prefix(a: DataFrame, b: DataFrame, keys: list[str], order: str, item: str) -> DataFrame:
    """(keys, n): how many items two ordered lists share from their start."""
    both = a.select(*keys, order, F.col(item).alias("_a")).join(b.select(*keys, order, F.col(item).alias("_b")), [*keys, order], "full")
    broken = F.min(F.when(~F.col("_a").eqNullSafe(F.col("_b")), F.col(order)))
    per = both.groupBy(*keys).agg(broken.alias("_x"), F.max(order).alias("_m"), F.min(order).alias("_l"))
    return per.select(*keys, F.coalesce(F.col("_x") - F.col("_l"), F.col("_m") - F.col("_l") + 1).cast("long").alias("n"))


def numbered(df: DataFrame, order: list[str], per_task: int) -> DataFrame:
    """df with its number in the order and the task bundle of per_task rows that it belongs to.

    Numbers come from counts by partition of a range-sorted copy, so no window holds all rows. The copy
    with its partition and place is written first: both parts of the plan then see the same. Rows that
    the order leaves equal are ordered by a hash of the whole row; repeated rows get numbers that follow
    each other."""
    whole = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    ranged = df.withColumn("_h", whole).repartitionByRange(*order, "_h").sortWithinPartitions(*order, "_h").withColumn("_p", F.spark_partition_id())
    ranged = Rounds(df.sparkSession).keep(ranged)
    ranged = ranged.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy(*order, "_h")))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    at = F.col("_k") + F.col("_b") - 1
    return ranged.join(F.broadcast(before), "_p").withColumns({"number": at, "task": F.floor(at / per_task)}).drop("_p", "_k", "_b", "_h")  # a row for each partition


def within(df: DataFrame, flag: Column) -> DataFrame:
    return df.where(F.coalesce(flag, F.lit(False)))
