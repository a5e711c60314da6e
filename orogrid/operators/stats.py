"""Aggregates over rasters: robust filters, least squares from sums, coverage, polygons."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percentile_spread(df: DataFrame, value: str, low: float = 0.2, high: float = 0.8, out: str = "spread") -> DataFrame:
    """(rid, out): difference of two percentiles with linear interpolation."""
    return df.groupBy("rid").agg((F.percentile(value, high) - F.percentile(value, low)).alias(out))


def medians(df: DataFrame, value: str, out: str = "median") -> DataFrame:
    """(rid, out): the exact median, without a table of all distinct values in one task.

    A sketch brackets it, the values between the brackets (about 0.4 percent) are counted and ranked, and a raster whose
    sketch missed takes Spark's own median."""
    v = F.col(value).cast("double")
    df = df.select("rid", v.alias("_v")).where("_v is not null")
    told = df.groupBy("rid").agg(F.percentile_approx("_v", [0.498, 0.502], 10_000).alias("_b"), F.count("*").alias("_n"))
    near = F.when(F.col("_v") >= F.get("_b", F.lit(0)), F.col("_v"))  # null: below the brackets
    near = df.join(told, "rid").where(F.col("_v") <= F.get("_b", F.lit(1))).groupBy("rid", "_n", near.alias("_v")).agg(F.count("*").alias("_k"))
    near = near.withColumn("_to", F.sum("_k").over(Window.partitionBy("rid").orderBy(F.col("_v").asc_nulls_first())))
    at = lambda rank: F.max(F.when((F.col("_to") - F.col("_k") <= rank) & (rank < F.col("_to")), F.col("_v")))
    a, b = at(F.floor((F.col("_n") - 1) / 2)), at(F.floor(F.col("_n") / 2))
    got = near.groupBy("rid").agg((0.5 * a + 0.5 * b).alias("_m"))
    missed = df.join(got.where("_m is null").select("rid"), "rid", "left_semi").groupBy("rid").agg(F.median("_v").alias("_own"))
    return got.join(missed, "rid", "left").select("rid", F.coalesce("_m", "_own").alias(out))


def outlier_filter(df: DataFrame, value: str, sigmas: float = 3.0) -> DataFrame:
    """The pixels within `sigmas` population deviations of the median, by raster."""
    told = df.groupBy("rid").agg(F.stddev_pop(value).alias("_dev")).join(medians(df, value, "_mid"), "rid")
    return df.join(F.broadcast(told), "rid").where(F.abs(F.col(value) - F.col("_mid")) <= sigmas * F.col("_dev")).drop("_mid", "_dev")


def rmse(c: Column) -> Column:
    return F.sqrt(F.avg(c * c))


def out_of_range(df: DataFrame, value: str, low: float, high: float, nodata: float | None = None) -> DataFrame:
    """Pixels whose value is neither nodata nor within the range."""
    v = F.col(value)
    bad = ~v.between(low, high)
    return df.where(v.isNotNull() & (bad & (v != nodata) if nodata is not None else bad))


def normal_sums(df: DataFrame, y: str, x1: str, x2: str) -> DataFrame:
    """(rid, sums): all that a fit y ~ 1 + x1 + x2 needs, in one aggregate with map-side sums."""
    c = {n: F.col(n).cast("double") for n in (y, x1, x2)}
    ok = c[y].isNotNull() & c[x1].isNotNull() & c[x2].isNotNull()
    terms = {"n": F.lit(1.0), "s1": c[x1], "s2": c[x2], "sy": c[y], "s11": c[x1] * c[x1], "s12": c[x1] * c[x2], "s22": c[x2] * c[x2], "s1y": c[x1] * c[y], "s2y": c[x2] * c[y], "syy": c[y] * c[y]}
    return df.where(ok).groupBy("rid").agg(*[F.sum(t).alias(n) for n, t in terms.items()])


def solve(sums: DataFrame) -> DataFrame:
    """sums with b0, b1, b2, the error variance s2e, and the diagonal v0, v1, v2 of the inverse: a 3 x 3 system solved by cofactors."""
    m = [[F.col("n"), F.col("s1"), F.col("s2")], [F.col("s1"), F.col("s11"), F.col("s12")], [F.col("s2"), F.col("s12"), F.col("s22")]]

    def minor(i: int, j: int) -> Column:
        r, c = [k for k in range(3) if k != i], [k for k in range(3) if k != j]
        return (m[r[0]][c[0]] * m[r[1]][c[1]] - m[r[0]][c[1]] * m[r[1]][c[0]]) * (-1) ** (i + j)

    det = m[0][0] * minor(0, 0) + m[0][1] * minor(0, 1) + m[0][2] * minor(0, 2)
    rhs = [F.col("sy"), F.col("s1y"), F.col("s2y")]
    d = F.nullif(det, F.lit(0.0))
    b = [(minor(0, i) * rhs[0] + minor(1, i) * rhs[1] + minor(2, i) * rhs[2]) / d for i in range(3)]
    out = sums.withColumns({f"b{i}": x for i, x in enumerate(b)} | {f"v{i}": minor(i, i) / d for i in range(3)})
    left = F.col("syy") - F.col("b0") * F.col("sy") - F.col("b1") * F.col("s1y") - F.col("b2") * F.col("s2y")
    return out.withColumn("s2e", F.greatest(left, F.lit(0.0)) / F.nullif(F.col("n") - 3, F.lit(0.0)))


def fit_plane(df: DataFrame, y: str, x1: str, x2: str) -> DataFrame:
    """(rid, n, b0, b1, b2, se0, se1, se2): least squares with standard errors; null for fewer than four pixels or a singular system."""
    got = solve(normal_sums(df, y, x1, x2))
    return got.select("rid", F.col("n").cast("long").alias("n"), "b0", "b1", "b2", *[F.sqrt(F.col("s2e") * F.col(f"v{i}")).alias(f"se{i}") for i in range(3)])


def t_quantile(p: float, dof: float) -> float:
    """Quantile of Student's t. The distribution function comes from the incomplete beta function's continued
    fraction, and bisection inverts it; from 10,000 degrees of freedom on a normal expansion is as exact."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(p)
    if dof > 1e4:
        return z + (z**3 + z) / (4 * dof) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * dof * dof)

    def beta(x: float, a: float, b: float) -> float:
        if x <= 0 or x >= 1:
            return float(x >= 1)
        if x > (a + 1) / (a + b + 2):
            return 1 - beta(1 - x, b, a)
        front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
        f, c, d = 1.0, 1.0, 0.0
        for i in range(400):
            k = i // 2
            num = 1.0 if i == 0 else k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)) if i % 2 == 0 else -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
            d = 1 / ((1 + num * d) or 1e-300)
            c = (1 + num / c) or 1e-300
            f *= c * d
            if abs(c * d - 1) < 1e-15:
                break
        return front * (f - 1)

    def cdf(t: float) -> float:
        tail = beta(dof / (dof + t * t), dof / 2, 0.5) / 2
        return 1 - tail if t > 0 else tail

    low, high = -1e3, 1e3
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return (low + high) / 2


def ring_measures(points: DataFrame, keys: list[str], order: str, x: str = "x", y: str = "y") -> DataFrame:
    """(keys, area, perimeter) of rings given as ordered points, closed or not."""
    w = Window.partitionBy(*keys).orderBy(order)
    first = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nx = F.coalesce(F.lead(x).over(w), F.first(x).over(first))
    ny = F.coalesce(F.lead(y).over(w), F.first(y).over(first))
    legs = points.withColumns({"_nx": nx, "_ny": ny})
    cross = F.col(x) * F.col("_ny") - F.col("_nx") * F.col(y)
    length = F.sqrt((F.col("_nx") - F.col(x)) * (F.col("_nx") - F.col(x)) + (F.col("_ny") - F.col(y)) * (F.col("_ny") - F.col(y)))
    return legs.groupBy(*keys).agg((F.abs(F.sum(cross)) / 2).alias("area"), F.sum(length).alias("perimeter"))


def coverage(df: DataFrame, z: str, match: str, mask: str, pixel_area: float, footprint_area: float | Column) -> DataFrame:
    """Coverage by raster: heights and matches, and the share of water, cloud and both among pixels off the edge."""
    area = footprint_area if isinstance(footprint_area, Column) else F.lit(float(footprint_area))
    share = lambda n: n * pixel_area / area
    off_edge = F.col(mask).bitwiseAND(1) == 0
    part = lambda bit: F.count_if(off_edge & (F.col(mask).bitwiseAND(bit) > 0))
    matched = F.coalesce(F.col(match) > 0, F.lit(False))
    return df.groupBy("rid").agg(
        (F.count(z) / F.nullif(F.count_if(off_edge), F.lit(0))).alias("dem_coverage"),
        share(F.count_if(matched)).alias("data_density"),
        share(F.count_if(matched & (F.col(mask) == 0))).alias("masked_density"),
        share(part(2)).alias("water"), share(part(4)).alias("cloud"), share(F.count_if(off_edge & (F.col(mask) > 0))).alias("combined"),
        F.min(z).alias("least"), F.max(z).alias("most"),
    )


def difference_report(df: DataFrame, keys: list[str], diff: str, order: str) -> DataFrame:
    """Mean, median, deviation, and value and row of the greatest absolute difference (the first of equal ones)."""
    best = F.max_by(F.struct(F.col(diff).alias("v"), F.col(order).alias("at")), F.struct(F.abs(diff).alias("a"), (-F.col(order)).alias("b")))
    return df.where(F.col(diff).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.avg(diff).alias("mean"), F.median(diff).alias("median"), F.stddev_pop(diff).alias("std"), best.alias("_m")).withColumns({"at_most": F.col("_m.v"), "row_at_most": F.col("_m.at")}).drop("_m")
