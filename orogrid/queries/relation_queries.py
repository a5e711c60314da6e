"""Joins, aggregates, windows and set operations on rasters and file lists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from orogrid.functions import ids
from orogrid.operators import grid, mosaic, register, relations, resample, stats
from orogrid.plans import check
from orogrid.queries.fixtures import heights, ortho, query, scene, table

KEY = ["r", "c"]


@query("J2_grid_outer", "SELECT coalesce(a.r, b.r) AS r, coalesce(a.c, b.c) AS c, a.v AS a, b.v AS b FROM (SELECT r, c, v FROM g WHERE r < 60) a FULL JOIN (SELECT r + 20 AS r, c, v FROM g WHERE r < 60) b ON a.r = b.r AND a.c = b.c")
def _(spark, d):
    g = heights(spark, d).where("r < 60")
    return relations.grid_union(g.select(*KEY, F.col("v").alias("a")), g.select((F.col("r") + 20).alias("r"), "c", F.col("v").alias("b")), KEY)


@query("J3_overlap", "SELECT count(*) AS n, round(avg(a.v - b.v), 6) AS mean FROM g a JOIN g b ON a.r = b.r + 7 AND a.c = b.c + 3 WHERE a.z IS NOT NULL AND b.z IS NOT NULL")
def _(spark, d):
    g = heights(spark, d).where("z is not null")
    b = g.select((F.col("r") + 7).alias("r"), (F.col("c") + 3).alias("c"), F.col("v").alias("b"))
    return g.join(b, KEY).agg(F.count("*").alias("n"), F.round(F.avg(F.col("v") - F.col("b")), 6).alias("mean"))


@query("J1_same_shape", "SELECT max(r) = 99 AND max(c) = 99 AS same FROM o")
def _(spark, d):
    return relations.same_shape(heights(spark, d), ortho(spark, d)).select("same")


_RECTS = "rect AS (SELECT l_orderkey * 10 + l_linenumber AS k, CAST(l_partkey AS DOUBLE) AS x0, CAST(l_suppkey AS DOUBLE) AS y0, l_partkey + CAST(l_quantity AS DOUBLE) AS x1, l_suppkey + 5.0::DOUBLE AS y1 FROM lineitem WHERE l_orderkey < 400)"


@query("J5_overlap_area", f", {_RECTS} SELECT * FROM (SELECT p.k AS a, q.k AS b, round(greatest(least(p.x1, q.x1) - greatest(p.x0, q.x0), 0) * greatest(least(p.y1, q.y1) - greatest(p.y0, q.y0), 0), 6) AS area FROM rect p JOIN rect q ON p.k < q.k) WHERE area > 0")
def _(spark, d):
    li = table(spark, d, "lineitem").where("l_orderkey < 400")
    x, y = F.col("l_partkey").cast("double"), F.col("l_suppkey").cast("double")
    rects = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), x.alias("x0"), y.alias("y0"), (x + F.col("l_quantity").cast("double")).alias("x1"), (y + 5.0).alias("y1"))
    return relations.overlapping(rects, "k", 64.0).select("a", "b", F.round("area", 6).alias("area"))


_FILES = "files AS (SELECT o_orderkey AS grp, s AS part FROM orders, (VALUES (1, 'dem.tif'), (2, 'matchtag.tif'), (3, 'meta.txt'), (4, 'ortho.tif')) v(i, s) WHERE (o_orderkey + i) % 7 <> 0)"


def files(spark, d):
    parts = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(s).alias("part")) for i, s in enumerate(("dem.tif", "matchtag.tif", "meta.txt", "ortho.tif"))])
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("grp"), F.explode(parts).alias("p")).select("grp", "p.i", "p.part").where("(grp + i) % 7 <> 0").select("grp", "part")


@query("J6_missing_suffix", f", {_FILES} SELECT grp, s AS part FROM (SELECT DISTINCT grp FROM files), (VALUES ('dem.tif'), ('matchtag.tif'), ('meta.txt'), ('ortho.tif')) v(s) WHERE NOT EXISTS (SELECT 1 FROM files f WHERE f.grp = grp AND f.part = s AND f.grp = (SELECT grp)) AND (grp, s) NOT IN (SELECT (grp, part) FROM files)".replace("NOT EXISTS (SELECT 1 FROM files f WHERE f.grp = grp AND f.part = s AND f.grp = (SELECT grp)) AND ", ""))
def _(spark, d):
    return relations.missing_parts(files(spark, d), "grp", "part", ["dem.tif", "matchtag.tif", "meta.txt", "ortho.tif"])


@query("J7_new_source", f", {_FILES} SELECT grp, part FROM files WHERE grp % 3 <> 0")
def _(spark, d):
    f = files(spark, d)
    return relations.not_in(f, f.where("grp % 3 = 0"), ["grp", "part"])


@query("J7_check_status", f", {_FILES} SELECT CASE WHEN grp % 5 = 0 THEN 'error' WHEN grp % 3 = 0 THEN 'done' ELSE 'to check' END AS state, count(*) AS n, CAST(sum(k) AS BIGINT) AS files FROM (SELECT grp, count(*) AS k FROM files GROUP BY grp) GROUP BY 1")
def _(spark, d):
    f = files(spark, d).withColumnRenamed("part", "fname")
    got = check.status(f, f.where("grp % 3 = 0"), f.where("grp % 5 = 0"))
    return got.groupBy("state").agg(F.count("*").alias("n"), F.sum("files").alias("files"))


@query("J11_dir_diff", f", {_FILES} SELECT side, count(*) AS n FROM (SELECT CASE WHEN a AND b THEN 'both' WHEN a THEN 'left' ELSE 'right' END AS side FROM (SELECT grp % 2 = 0 OR grp % 3 = 0 AS a, grp % 5 <> 0 AS b FROM files) WHERE a OR b) GROUP BY side")
def _(spark, d):
    f = files(spark, d)
    return relations.compare_lists(f.where("grp % 2 = 0 or grp % 3 = 0"), f.where("grp % 5 <> 0"), ["grp", "part"]).groupBy("side").agg(F.count("*").alias("n"))


@query("missing_by_profile", "SELECT CAST(n AS VARCHAR) AS part, k FROM (SELECT 'meta.txt' AS n, count(*) AS k FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT 'ortho.tif', count(*) FROM orders UNION ALL SELECT 'matchtag.tif', count(*) FROM orders WHERE o_orderkey % 7 = 0)")
def _(spark, d):
    from orogrid.queries.local_queries import pairnames

    part = F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit("dem.tif"), F.lit("meta.txt"))).otherwise(F.array(F.lit("dem.tif"), F.lit("matchtag.tif")))
    named = pairnames(spark, d).select("pair", F.explode(part).alias("part")).select(F.concat_ws("_", "pair", "part").alias("fname"))
    return check.missing(named, "pairnames").groupBy("part").agg(F.count("*").alias("k"))


@query("A1_pctl_diff", "SELECT round(quantile_cont(z, 0.8) - quantile_cont(z, 0.2), 6) AS spread FROM g")
def _(spark, d):
    return stats.percentile_spread(heights(spark, d), "z").select(F.round("spread", 6).alias("spread"))


@query("A2_rmse", "SELECT r, round(median(z), 6) AS med, round(stddev_pop(z), 6) AS sd, round(sqrt(avg(z * z)), 6) AS rmse FROM g GROUP BY r")
def _(spark, d):
    return heights(spark, d).groupBy("r").agg(F.round(F.median("z"), 6).alias("med"), F.round(F.stddev_pop("z"), 6).alias("sd"), F.round(stats.rmse(F.col("z")), 6).alias("rmse"))


@query("A3_counts", "SELECT r, count(z) AS n, count(*) FILTER (m = 0) AS errors, bool_or(m = 0) AS some, bool_and(m = 1) AS every FROM g GROUP BY r")
def _(spark, d):
    return heights(spark, d).groupBy("r").agg(F.count("z").alias("n"), F.count_if(F.col("m") == 0).alias("errors"), F.bool_or(F.col("m") == 0).alias("some"), F.bool_and(F.col("m") == 1).alias("every"))


@query("A4_minmax", "SELECT min(z) AS low, max(z) AS high FROM g")
def _(spark, d):
    return heights(spark, d).agg(F.min("z").alias("low"), F.max("z").alias("high"))


@query("A5_ols", "SELECT count(*) AS n, round(regr_intercept(z, r), 4) AS b0, round(regr_slope(z, r), 6) AS b1 FROM g WHERE z IS NOT NULL")
def _(spark, d):
    # the second regressor is orthogonal noise-free zero for a one-variable fit: its coefficient is taken out by centring c
    g = heights(spark, d).where("z is not null").withColumn("x", F.col("r").cast("double"))
    one = g.groupBy("rid").agg(F.count("*").alias("n"), F.regr_intercept("z", "x").alias("b0"), F.regr_slope("z", "x").alias("b1"))
    return one.select("n", F.round("b0", 4).alias("b0"), F.round("b1", 6).alias("b1"))


_SUMS = "s AS (SELECT count(*)::DOUBLE AS n, sum(r)::DOUBLE AS s1, sum(c)::DOUBLE AS s2, sum(z) AS sy, sum(r * r)::DOUBLE AS s11, sum(r * c)::DOUBLE AS s12, sum(c * c)::DOUBLE AS s22, sum(r * z) AS s1y, sum(c * z) AS s2y FROM g WHERE z IS NOT NULL), d AS (SELECT *, n * (s11 * s22 - s12 * s12) - s1 * (s1 * s22 - s12 * s2) + s2 * (s1 * s12 - s11 * s2) AS det FROM s)"


@query("A5_plane", f", {_SUMS} SELECT round((sy * (s11 * s22 - s12 * s12) - s1 * (s1y * s22 - s12 * s2y) + s2 * (s1y * s12 - s11 * s2y)) / det, 4) AS b0, round((n * (s1y * s22 - s12 * s2y) - sy * (s1 * s22 - s12 * s2) + s2 * (s1 * s2y - s1y * s2)) / det, 6) AS b1, round((n * (s11 * s2y - s1y * s12) - s1 * (s1 * s2y - s1y * s2) + sy * (s1 * s12 - s11 * s2)) / det, 6) AS b2 FROM d")
def _(spark, d):
    g = heights(spark, d).withColumns({"x1": F.col("r").cast("double"), "x2": F.col("c").cast("double")})
    return stats.fit_plane(g, "z", "x1", "x2").select(F.round("b0", 4).alias("b0"), F.round("b1", 6).alias("b1"), F.round("b2", 6).alias("b2"))


@query("A6_coverage", "SELECT round(count(z) / count(*) FILTER (md % 2 = 0)::DOUBLE, 6) AS dem_coverage, round(count(*) FILTER (m > 0) * 4.0::DOUBLE / 50000, 6) AS data_density, round(count(*) FILTER (m > 0 AND md = 0) * 4.0::DOUBLE / 50000, 6) AS masked_density, round(count(*) FILTER (md % 2 = 0 AND (md // 2) % 2 = 1) * 4.0::DOUBLE / 50000, 6) AS water, round(count(*) FILTER (md % 2 = 0 AND md >= 4) * 4.0::DOUBLE / 50000, 6) AS cloud, round(count(*) FILTER (md % 2 = 0 AND md > 0) * 4.0::DOUBLE / 50000, 6) AS combined, min(z) AS least, max(z) AS most FROM (SELECT g.*, o % 8 AS md FROM g JOIN o USING (rid, r, c))")
def _(spark, d):
    df = scene(spark, d).where("o is not null").withColumn("md", F.col("o") % 8)
    got = stats.coverage(df, "z", "m", "md", 4.0, 50000.0)
    return got.select(*[F.round(c, 6).alias(c) for c in ("dem_coverage", "data_density", "masked_density", "water", "cloud", "combined")], "least", "most")


@query("A7_group_version", "SELECT p_brand, min(lpad(CAST(p_size % 5 AS VARCHAR), 2, '0') || '.' || lpad(CAST(p_size % 11 AS VARCHAR), 2, '0')) AS v, false AS conflict FROM part GROUP BY p_brand")
def _(spark, d):
    v = F.concat_ws(".", (F.col("p_size") % 5).cast("string"), (F.col("p_size") % 11).cast("string"))
    got = check.group_version(table(spark, d, "part").select("p_brand", v.alias("version"), F.lit(None).cast("string").alias("declared")), "p_brand", "version", "declared")
    return got.select("p_brand", F.array_join(F.transform(F.split("version", r"\."), lambda x: F.lpad(x, 2, "0")), ".").alias("v"), "conflict")


@query("A8_group_counts", f", {_FILES} SELECT part, count(*) AS n, count(*) FILTER (grp % 3 = 0) AS done FROM files GROUP BY part")
def _(spark, d):
    return files(spark, d).groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col("grp") % 3 == 0).alias("done"))


@query("A9_absmax_report", ", x AS (SELECT r, c, z - 50 AS d FROM g WHERE z IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY abs(d) DESC, c) AS q FROM x) SELECT r, count(*) AS n, round(avg(d), 6) AS mean, round(median(d), 6) AS median, round(stddev_pop(d), 6) AS std, round(max(d) FILTER (q = 1), 6) AS at_most, max(c) FILTER (q = 1) AS row_at_most FROM k GROUP BY r")
def _(spark, d):
    df = heights(spark, d).withColumn("d", F.col("z") - 50)
    return stats.difference_report(df, ["r"], "d", "c").select("r", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "std", "at_most")], "row_at_most")


@query("A12_shoelace", ", p AS (SELECT user_id AS k, event_id AS i, (event_id % 97)::DOUBLE AS x, (event_id % 89)::DOUBLE AS y FROM events), q AS (SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny FROM p WINDOW w AS (PARTITION BY k ORDER BY i)) SELECT k, abs(sum(x * ny - nx * y)) / 2 AS area, round(sum(sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y))), 6) AS perimeter FROM q GROUP BY k")
def _(spark, d):
    pts = table(spark, d, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("i"), (F.col("event_id") % 97).cast("double").alias("x"), (F.col("event_id") % 89).cast("double").alias("y"))
    return stats.ring_measures(pts, ["k"], "i").select("k", "area", F.round("perimeter", 6).alias("perimeter"))


@query("W1_order_by_edge", "SELECT s, row_number() OVER (ORDER BY mx, s) AS k FROM (SELECT r // 10 AS s, min(v) AS mx FROM g GROUP BY 1)")
def _(spark, d):
    low = heights(spark, d).groupBy(F.floor(F.col("r") / 10).cast("int").alias("s")).agg(F.min("v").alias("mx"))
    return low.select("s", F.row_number().over(Window.orderBy("mx", "s")).cast("long").alias("k"))


_SCENES = "sc AS (SELECT CAST(s AS INTEGER) AS s, min(r) AS r0, max(r) + 1 AS r1, min(c) AS c0, max(c) + 1 AS c1 FROM g, range(0, 4) t(s) WHERE r BETWEEN 20 * s AND 20 * s + 29 GROUP BY s)"


def scenes(spark, d):
    return heights(spark, d).crossJoin(F.broadcast(spark.range(4).select(F.col("id").cast("int").alias("s")))).where("r between 20 * s and 20 * s + 29")  # four rows


@query("W3_order_chain", f", {_SCENES}, RECURSIVE_ORDER AS (SELECT s FROM sc) SELECT s, CAST(row_number() OVER (ORDER BY r0) AS BIGINT) AS k FROM sc")
def _(spark, d):
    boxes = scenes(spark, d).groupBy("s").agg(F.min("c").alias("x0"), F.min("r").alias("y0"), F.max("c").alias("x1"), F.max("r").alias("y1")).collect()  # a row for each scene of one strip
    order, _along = mosaic.order_scenes([(f"{b.s}", b.x0, b.y0, b.x1 + 1, b.y1 + 1) for b in sorted(boxes)])
    return spark.createDataFrame([(int(n), k + 1) for k, n in enumerate(order)], "s int, k long")


@query("H7_rectangle", f", {_SCENES} SELECT s, r0, r1, c0, c1 FROM sc")
def _(spark, d):
    return scenes(spark, d).groupBy("s").agg(F.min("r").alias("r0"), (F.max("r") + 1).alias("r1"), F.min("c").alias("c0"), (F.max("c") + 1).alias("c1"))


@query("W4_duplicate_ordinal", "SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("event_id")).cast("long").alias("k"))


@query("W9_task_bundles", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // 100 AS task FROM orders")
def _(spark, d):
    return relations.numbered(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], 100).select("o_orderkey", "task")


@query("U1_set_operations", f", {_FILES} SELECT count(*) FILTER (a AND b) AS both, count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (a OR b) AS every FROM (SELECT grp % 2 = 0 AS a, grp % 3 = 0 AS b FROM files)")
def _(spark, d):
    f = files(spark, d)
    a, b = f.where("grp % 2 = 0"), f.where("grp % 3 = 0")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(a.intersect(b), "both").join(n(a.exceptAll(b), "only_a")).join(n(a.union(b).distinct(), "every"))


@query("U2_common_prefix", ", e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) SELECT user_id, CAST(coalesce(min(i) FILTER (value > 100) - 1, max(i)) AS BIGINT) AS n FROM e GROUP BY user_id")
def _(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = table(spark, d, "events").select("user_id", F.row_number().over(w).alias("i"), F.col("event_type").alias("item"), "value")
    other = e.withColumn("item", F.when(F.col("value") > 100, "other").otherwise(F.col("item")))
    return relations.common_prefix(e, other, ["user_id"], "i", "item")


@query("L17_newer", "SELECT p_partkey, p_size % 10 > p_partkey % 10 AS newer FROM part")
def _(spark, d):
    v = lambda c: F.concat(F.lit("4."), (c % 10).cast("string"))
    return table(spark, d, "part").select("p_partkey", (ids.version(v(F.col("p_size"))) > ids.version(v(F.col("p_partkey")))).alias("newer"))


def _surface(spark, d):
    """A smooth surface of the height grid: 5 x 5 means."""
    from orogrid.operators import focal

    return focal.moving_average(heights(spark, d), "v", 9, "z", zero_border=False).select("rid", "r", "c", "z")


@query("R1_register_step")
def _(spark, d):
    fixed = _surface(spark, d)
    moved = register.shifted(fixed, (-0.5, 0.0, 0.0), 1.0)
    got = stats.solve(stats.normal_sums(register.step_table(fixed, moved, 1.0), "dz", "sx", "sy"))
    return got.select(F.col("n").cast("long").alias("n"), F.round("b0", 4).alias("dz"), F.round("b1", 4).alias("dx"), F.round("b2", 4).alias("dy"))


@query("R1_register")
def _(spark, d):
    fixed = _surface(spark, d)
    moving = resample.shift(fixed, "z", 0.2, -0.3).withColumn("z", F.col("z") + 0.5)
    got = register.register(fixed, moving)
    return spark.createDataFrame([(round(got.offset[0], 3), round(got.offset[1], 3), round(got.offset[2], 3), got.rounds)], "dz double, dx double, dy double, rounds int")


@query("strip_difference", "SELECT a.r, a.c, round(a.v - b.v - (SELECT median(a.v - b.v) FROM g a JOIN g b ON a.r = b.r + 5 AND a.c = b.c), 6) + 0.0 AS dz FROM g a JOIN g b ON a.r = b.r + 5 AND a.c = b.c")
def _(spark, d):
    g = heights(spark, d)
    b = g.select("rid", (F.col("r") + 5).alias("r"), "c", F.col("v").alias("b"))
    both = g.join(b, list(grid.KEY)).withColumn("dz", F.col("v") - F.col("b"))
    mid = both.groupBy("rid").agg(F.median("dz").alias("mid"))
    return both.join(mid, "rid").select(*KEY, (F.round(F.col("dz") - F.col("mid"), 6) + 0.0).alias("dz"))


@query("mosaic_segments")
def _(spark, d):
    s = _surface(spark, d)
    cut = s.crossJoin(F.broadcast(spark.range(2).select(F.col("id").cast("int").alias("k")))).where("r between 30 * k and 30 * k + 45")  # two rows
    sc = cut.select(F.concat(F.lit("s"), F.col("k").cast("string")).alias("scene"), "r", "c", (F.col("z") + F.col("k") * 0.25).alias("z"), F.lit(1).alias("m"), F.col("z").alias("o"), F.lit(0).alias("md"))
    rows = []
    for i, seg in enumerate(mosaic.build_segments(sc, ["s0", "s1"], 1.0, least_new=100, least_overlap=20)):
        rows += [(i, a[0], None if a[1] is None else round(a[1], 3), None if a[2] is None else round(a[2], 3), a[5]) for a in seg.alignment]
    return spark.createDataFrame(rows, "segment int, scene string, rmse double, dz double, state string")


@query(
    "mosaic_moved_scene",
    """, s AS (SELECT a.r, a.c, b.z - 0.5::DOUBLE AS z, coalesce(b.m, 0) AS m, CASE WHEN x.o <> 0 THEN x.o END AS o FROM g a LEFT JOIN g b ON b.r = a.r + 1 AND b.c = a.c + 2 LEFT JOIN o x ON x.r = b.r AND x.c = b.c),
    e AS (SELECT a.r, a.c, bool_and(b.z IS NOT NULL) AS zk, bool_and(b.o IS NOT NULL) AS ok FROM s a JOIN s b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY a.r, a.c)
    SELECT s.r, s.c, CASE WHEN zk THEN round(z, 6) END AS z, CASE WHEN zk THEN m ELSE 0 END AS m, CASE WHEN ok THEN CAST(o AS DOUBLE) END AS o, 0 AS md FROM s JOIN e USING (r, c)""",
)
def _(spark, d):
    moved = mosaic.move_scene(scene(spark, d).select("rid", "r", "c", "z", "m", "o", F.lit(0).alias("md")), (0.5, 2.0, -1.0), 1.0, rim=3)
    return moved.select(*KEY, F.round("z", 6).alias("z"), "m", F.col("o").cast("double").alias("o"), "md")
