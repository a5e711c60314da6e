"""Composite masks and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from orogrid.functions import local
from orogrid.operators import focal
from orogrid.plans import masks
from orogrid.queries.fixtures import heights, query, scene

KEY = ["r", "c"]

_MEAN = "mean AS (SELECT a.r, a.c, CASE WHEN count(*) FILTER (b.gr IS NULL) = 0 THEN sum(b.gr) / 25 END AS ms FROM grade a JOIN grade b ON abs(a.r - b.r) <= 2 AND abs(a.c - b.c) <= 2 GROUP BY a.r, a.c)"
_GRADE = """grade AS (SELECT r, c, sqrt(gx * gx + gy * gy) AS gr FROM (SELECT r, c,
  CASE WHEN r = 0 THEN d - z WHEN r = 99 THEN z - u ELSE (d - u) / 2 END / 40 AS gy, CASE WHEN c = 0 THEN x - z WHEN c = 99 THEN z - l ELSE (x - l) / 2 END / 40 AS gx
  FROM (SELECT r, c, z, lag(z) OVER (PARTITION BY c ORDER BY r) AS u, lead(z) OVER (PARTITION BY c ORDER BY r) AS d, lag(z) OVER (PARTITION BY r ORDER BY c) AS l, lead(z) OVER (PARTITION BY r ORDER BY c) AS x FROM base)))"""


def _slope_sql(base: str) -> str:
    return f", base AS ({base}), {_GRADE}, {_MEAN}, steep AS (SELECT a.r, a.c, max(CASE WHEN b.ms > 1 THEN 1 ELSE 0 END) > 0 OR min(a.ms) IS NULL AS slope FROM mean a JOIN mean b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY a.r, a.c)"


_SPARSE = "SELECT r, c, CASE WHEN r * 100 + c = 4550 THEN NULL ELSE v END AS z FROM g"


def _sparse(spark, d):
    return heights(spark, d).withColumn("z", F.when(F.col("r") * 100 + F.col("c") != 4550, F.col("v")))


@query("M6_slope_mask", _slope_sql(_SPARSE) + " SELECT r, c, slope FROM steep")
def _(spark, d):
    return masks.slope_mask(_sparse(spark, d), 40.0, k=5, dilate=3).select(*KEY, "slope")


@query(
    "bitmask_report",
    _slope_sql(_SPARSE)
    + ", dens AS (SELECT a.r, a.c, sum(b.m) / 25.0::DOUBLE AS density FROM g a JOIN g b ON abs(a.r - b.r) <= 2 AND abs(a.c - b.c) <= 2 GROUP BY a.r, a.c),"
    " bm AS (SELECT CAST(CASE WHEN slope THEN 1 ELSE 0 END + CASE WHEN density < 0.7 THEN 2 ELSE 0 END + CASE WHEN g.v > 115 THEN 4 ELSE 0 END AS INTEGER) AS mask, base.z FROM steep JOIN dens USING (r, c) JOIN g USING (r, c) JOIN base USING (r, c))"
    " SELECT mask, count(*) AS n, round(avg(z), 6) AS mean_z FROM bm GROUP BY mask",
)
def _(spark, d):
    df = focal.data_density(masks.slope_mask(_sparse(spark, d), 40.0, k=5, dilate=3), F.col("m") > 0, 5)
    df = df.withColumn("mask", local.bitmask(F.col("slope"), F.col("density") < 0.7, F.col("v") > 115))
    return masks.coverage_report(df).select("mask", "n", F.round("mean_z", 6).alias("mean_z"))


@query("P1_thresholds", "SELECT r, c, coalesce(o > 1000, false) AND m = 0 AS bright, coalesce(o < 200, false) AS dark FROM g LEFT JOIN o USING (rid, r, c)")
def _(spark, d):
    o = F.col("o")
    return scene(spark, d).select(*KEY, (F.coalesce(o > 1000, F.lit(False)) & (F.col("m") == 0)).alias("bright"), F.coalesce(o < 200, F.lit(False)).alias("dark"))


@query("M13_apply_mask", "SELECT r, c, CASE WHEN (o % 8) & 6 > 0 THEN NULL ELSE z END AS z, CASE WHEN (o % 8) & 6 > 0 THEN 0 ELSE m END AS m FROM g JOIN o USING (rid, r, c)")
def _(spark, d):
    df = scene(spark, d).where("o is not null").withColumn("mask", F.col("o") % 8)
    return masks.apply_mask(df, "mask", local.WATER | local.CLOUD, {"z": None, "m": 0}).select(*KEY, "z", "m")


@query("M_box_deviation", "SELECT a.r, a.c, CASE WHEN count(*) FILTER (b.z IS NULL) = 0 THEN round(sqrt(greatest(sum(b.z * b.z) / 25 - (sum(b.z) / 25) * (sum(b.z) / 25), 0)), 6) END AS sigma FROM g a JOIN g b ON abs(a.r - b.r) <= 2 AND abs(a.c - b.c) <= 2 GROUP BY a.r, a.c")
def _(spark, d):
    return focal.box_deviation(heights(spark, d), "z", 5).select(*KEY, F.round("sigma", 6).alias("sigma"))


def _toned(spark, d):
    """A scene whose intensities stand for radiance."""
    return scene(spark, d).withColumns({"o": F.coalesce(F.col("o"), F.lit(0)) / 10.0, "z": F.col("v")})


@query("M7_water")
def _(spark, d):
    df = focal.data_density(_toned(spark, d), F.col("m") > 0, 5)
    return masks.water_mask(df, 40.0, least=3, grow=3).groupBy("water").agg(F.count("*").alias("n"))


@query("M8_cloud")
def _(spark, d):
    df = focal.data_density(_toned(spark, d), F.col("m") > 0, 5)
    return masks.cloud_mask(df, k=5, least=3, erode=3, grow_back=5, grow=3, gap=20).groupBy("cloud").agg(F.count("*").alias("n"))


@query("M9_edge")
def _(spark, d):
    df = heights(spark, d).withColumn("good", (F.col("m") > 0) & F.col("r").between(10, 80) & F.col("c").between(20, 70))
    return masks.edge_mask(df, "good", least=20).groupBy("edge").agg(F.count("*").alias("n"))


@query("M10_low_entropy")
def _(spark, d):
    return masks.entropy_mask(_toned(spark, d), k=3, thresh=2.0, least=4).groupBy("flat").agg(F.count("*").alias("n"))


@query("M3_scene_mask")
def _(spark, d):
    small = {"k": 5, "least": 3, "erode": 3, "grow_back": 5, "grow": 3, "gap": 20}
    return masks.scene_mask(_toned(spark, d), 40.0, 40.0, 5, small, 50).groupBy("mask").agg(F.count("*").alias("n"))


@query("M2_density_mask")
def _(spark, d):
    return masks.density_mask(heights(spark, d), 8.0, old=True).groupBy("mask").agg(F.count("*").alias("n"))


@query("M4_rough_mask")
def _(spark, d):
    return masks.rough_mask(_toned(spark, d), 40.0, k=5, rough=2.0, still=1.0, seed_least=3, grow=3, gap=10, rim=3).groupBy("mask").agg(F.count("*").alias("n"))


@query("M5_mask_8m")
def _(spark, d):
    return masks.mask_8m(_toned(spark, d)).groupBy("mask").agg(F.count("*").alias("n"))
