"""Local operations, predicates, identifiers and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from orogrid.functions import geo, ids, local
from orogrid.operators import relations, stats
from orogrid.plans import check
from orogrid.queries.fixtures import heights, ortho, query, scene, table
from orogrid.sources import text

KEY = ["r", "c"]


@query("S2_prune_bands", "SELECT r, c, m FROM g WHERE r < 50")
def _(spark, d):
    return heights(spark, d).where("r < 50").select(*KEY, "m")


@query("S4_scaled_decode", "SELECT r, c, CASE WHEN o = 0 THEN 0.0 ELSE o * 0.25 + 10 END::DOUBLE AS z FROM o")
def _(spark, d):
    return ortho(spark, d).select(*KEY, local.scaled(F.col("o").cast("double"), 0.25, 10.0, 0.0).alias("z"))


_KV = "kv AS (SELECT user_id AS file, event_id AS line_no, event_type AS bare, CAST(value AS DOUBLE) AS x FROM events WHERE event_id < 4000)"


@query(
    "S5_scene_meta",
    f", {_KV}, n AS (SELECT *, row_number() OVER (PARTITION BY file, bare ORDER BY line_no) AS k, count(*) OVER (PARTITION BY file, bare) AS t FROM kv) "
    "SELECT file, line_no, CASE WHEN t > 1 THEN 'image_' || k || '_' || bare ELSE bare END AS key, round(x, 4) AS val_num FROM n",
)
def _(spark, d):
    lines = table(spark, d, "events").where("event_id < 4000").select(F.col("user_id").alias("file"), F.col("event_id").alias("line_no"), F.concat_ws("=", "event_type", F.col("value").cast("string")).alias("line"))
    return text.key_values(lines).select("file", "line_no", "key", F.round("val_num", 4).alias("val_num"))


@query(
    "S6_xml_values",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer",
)
def _(spark, d):
    xml = F.concat(F.lit("<a:IMD><NATION id='1'>"), F.col("c_nationkey").cast("string"), F.lit("</NATION>"), F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("<x:NAME> "), "c_name", F.lit(" </x:NAME>"))).otherwise(""), F.lit("</a:IMD>"))
    got = text.xml_values(xml, ["NAME", "NATION"])
    return table(spark, d, "customer").select("c_custkey", got["NAME"].alias("name"), got["NATION"].alias("nation"))


_DOC = """docs AS (SELECT file, line_no, line FROM (SELECT CAST(user_id AS BIGINT) AS file, event_id AS line_no, CASE WHEN event_type = 'view' THEN 'Mosaicking Alignment Statistics (meters)' WHEN event_type = 'error' THEN 'Data Coverage Statistics' ELSE 'other' END AS line FROM events))"""


@query(
    "W5_sections",
    f", {_DOC}, s AS (SELECT file, line_no, last_value(CASE WHEN line LIKE 'Mosaicking%' THEN 'Mosaicking Alignment Statistics' WHEN line LIKE 'Data%' THEN 'Data Coverage Statistics' END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM docs) "
    "SELECT section, count(*) AS n, CAST(sum(line_no) AS BIGINT) AS total FROM s GROUP BY section",
)
def _(spark, d):
    kind = F.col("event_type")
    line = F.when(kind == "view", "Mosaicking Alignment Statistics (meters)").when(kind == "error", "Data Coverage Statistics").otherwise("other")
    lines = table(spark, d, "events").select(F.col("user_id").alias("file"), F.col("event_id").alias("line_no"), line.alias("line"))
    return text.sections(lines, text.STRIP_SECTIONS).groupBy("section").agg(F.count("*").alias("n"), F.sum("line_no").alias("total"))


@query(
    "S7_strip_alignment",
    "SELECT l_orderkey AS file, l_linenumber AS line_no, 'scene_' || l_partkey AS scene, CAST(l_quantity AS DOUBLE) AS rmse, CAST(l_suppkey AS DOUBLE) AS dz FROM lineitem WHERE l_orderkey < 2000",
)
def _(spark, d):
    li = table(spark, d, "lineitem").where("l_orderkey < 2000")
    row = F.concat_ws(" ", F.concat(F.lit("scene_"), F.col("l_partkey").cast("string")), F.col("l_quantity").cast("string"), F.col("l_suppkey").cast("string"), *[F.lit("nan")] * 5)
    head = li.select("l_orderkey").distinct().select(F.col("l_orderkey").alias("file"), F.lit(-2).cast("long").alias("line_no"), F.lit("Mosaicking Alignment Statistics (meters)").alias("line"))
    names = head.select("file", F.lit(-1).cast("long").alias("line_no"), F.lit("scene, rmse, dz, dx, dy, dz_err, dx_err, dy_err").alias("line"))
    lines = head.union(names).union(li.select("l_orderkey", F.col("l_linenumber").cast("long"), row))
    return text.strip_alignment(lines).join(li.select(F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("line_no"), F.row_number().over(_by_line()).alias("ord")), ["file", "ord"]).select("file", "line_no", "scene", "rmse", "dz")


def _by_line():
    from pyspark.sql import Window

    return Window.partitionBy("l_orderkey").orderBy("l_linenumber")


@query("S8_translation", "SELECT s_suppkey AS file, round(s_acctbal, 2) AS dz, CAST(s_nationkey AS DOUBLE) AS dx, CAST(s_suppkey AS DOUBLE) AS dy FROM supplier")
def _(spark, d):
    line = F.concat(F.lit("Translation Vector (dz,dx,dy)(m)= "), F.concat_ws(", ", F.round("s_acctbal", 2).cast("string"), F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string")))
    lines = table(spark, d, "supplier").select(F.col("s_suppkey").alias("file"), F.lit(0).alias("line_no"), line.alias("line"))
    return text.translation(lines)


@query("S11_suffix_priority", "SELECT o_custkey AS grp, min(CASE o_orderpriority WHEN '1-URGENT' THEN 'a_dem.tif' WHEN '2-HIGH' THEN 'b_dem_smooth.tif' END) AS fname FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY o_custkey")
def _(spark, d):
    name = F.when(F.col("o_orderpriority") == "1-URGENT", "a_dem.tif").when(F.col("o_orderpriority") == "2-HIGH", "b_dem_smooth.tif").otherwise("c_other.txt")
    files = table(spark, d, "orders").select(F.col("o_custkey").alias("grp"), name.alias("fname"))
    return relations.first_by_priority(files, "grp", "fname", ["dem.tif", "dem_smooth.tif"]).select("grp", "fname")


@query("L1_data_flag", "SELECT r, c, z IS NOT NULL AND z <> 7 AS data FROM g")
def _(spark, d):
    return heights(spark, d).select(*KEY, local.is_data(F.col("z"), 7.0).alias("data"))


@query("L2_round_half_away", "SELECT r, c, CAST(CASE WHEN x < 0 THEN -floor(-x + 0.5) ELSE floor(x + 0.5) END AS DOUBLE) AS v FROM (SELECT r, c, (o - 1024) / 2.0::DOUBLE AS x FROM o)")
def _(spark, d):
    return ortho(spark, d).select(*KEY, local.round_half_away((F.col("o") - 1024) / F.lit(2.0)).alias("v"))


@query("L3_quantize128", "SELECT r, c, round_even(CAST(o AS DOUBLE) / 3 * 128, 0) / 128 AS v FROM o")
def _(spark, d):
    return ortho(spark, d).select(*KEY, local.quantize(F.col("o").cast("double") / 3).alias("v"))


@query("L4_clip_cast", "SELECT r, c, CAST(greatest(least(round(o / 4.0::DOUBLE), 255), 0) AS INTEGER) AS v FROM o")
def _(spark, d):
    return ortho(spark, d).select(*KEY, local.clip_cast(F.col("o") / 4.0, "uint8").alias("v"))


@query("L5_calc_mask", "SELECT r, c, CASE WHEN m = 0 THEN z ELSE -9999.0 END AS v FROM g WHERE z IS NOT NULL")
def _(spark, d):
    return heights(spark, d).where("z is not null").select(*KEY, local.where_else(F.col("z"), F.col("m") == 0, -9999.0).alias("v"))


@query("L6_rescale_dn", "SELECT r, c, round(o * 2047.0::DOUBLE / 32767, 6) AS v FROM o")
def _(spark, d):
    return ortho(spark, d).select(*KEY, F.round(local.rescale_dn(F.col("o"), 2047.0), 6).alias("v"))


_CAL = "cal(sensor, gain, off) AS (VALUES ('WV03', 0.923::DOUBLE, -1.7::DOUBLE), ('WV02', 0.96, -2.957), ('GE01', 0.978, -1.948), ('QB02', 0.876, -2.157), ('IK01', 0.907, -4.461), ('WV01', 1.016, -3.932))"


@query("L7_radiance", f", {_CAL} SELECT r, c, CASE WHEN o <> 0 THEN round(gain * o * (0.05::DOUBLE / 0.4) + off, 6) END AS rad FROM o LEFT JOIN cal ON sensor = CASE WHEN r % 4 = 0 THEN 'WV01' WHEN r % 4 = 1 THEN 'QB02' WHEN r % 4 = 2 THEN 'IK01' ELSE 'GE01' END")
def _(spark, d):
    name = F.when(F.col("r") % 4 == 0, "WV01").when(F.col("r") % 4 == 1, "QB2").when(F.col("r") % 4 == 2, "IKO").otherwise("GE01")
    return local.radiance(ortho(spark, d).withColumn("sensor", name), "o", "sensor", F.lit(0.05), F.lit(0.4)).select(*KEY, F.round("radiance", 6).alias("rad"))


@query("L8_bitmask_compose", "SELECT r, c, CAST((CASE WHEN z IS NULL THEN 1 ELSE 0 END) + (CASE WHEN v < 20 THEN 2 ELSE 0 END) + (CASE WHEN m = 0 THEN 4 ELSE 0 END) AS INTEGER) AS mask FROM g")
def _(spark, d):
    return heights(spark, d).select(*KEY, local.bitmask(F.col("z").isNull(), F.col("v") < 20, F.col("m") == 0).alias("mask"))


@query("L9_bitmask_clear", "SELECT r, c, CAST(((o % 8) & 5) AS INTEGER) AS mask, (o % 8) & 5 > 0 AS hit FROM o")
def _(spark, d):
    kept = local.clear_bits(F.col("o") % 8, local.WATER)
    return ortho(spark, d).select(*KEY, kept.alias("mask"), (kept > 0).alias("hit"))


@query("L10_bitstring", "SELECT r, c, CAST((o // 4) % 2 AS VARCHAR) || CAST((o // 2) % 2 AS VARCHAR) || CAST(o % 2 AS VARCHAR) AS bits FROM o")
def _(spark, d):
    return ortho(spark, d).select(*KEY, local.bitstring(F.col("o")).alias("bits"))


@query("L11_mask_nodata_convert", "SELECT r, c, CASE WHEN m = 0 OR o = 0 THEN -1.0::DOUBLE ELSE CAST(o AS DOUBLE) END AS v FROM g JOIN o USING (rid, r, c)")
def _(spark, d):
    v, _nodata = local.nodata_policy(F.col("o").cast("double"), F.col("m") == 0, "convert", 0.0, -1.0)
    return scene(spark, d).where("o is not null").select(*KEY, v.alias("v"))


@query("L12_mask_or", "SELECT r, CAST(bit_or(o % 8) AS INTEGER) AS mask FROM o GROUP BY r")
def _(spark, d):
    return ortho(spark, d).groupBy("r").agg(F.bit_or(F.col("o") % 8).alias("mask"))


@query("L14_ramp", "SELECT r, c, round(least(greatest((o / 2048.0::DOUBLE - 0.25) / (0.55 - 0.25), 0), 1), 9) AS w FROM o")
def _(spark, d):
    return ortho(spark, d).select(*KEY, F.round(local.ramp(F.col("o") / 2048.0), 9).alias("w"))


@query("L15_blend", "SELECT r, c, round(CASE WHEN z IS NOT NULL AND o IS NOT NULL THEN z * 0.3 + o * 0.7 ELSE coalesce(z, o) END, 6) AS v FROM g FULL JOIN o USING (rid, r, c)")
def _(spark, d):
    both = relations.grid_union(heights(spark, d).select("rid", *KEY, "z"), ortho(spark, d), ["rid", "r", "c"])
    return both.select(*KEY, F.round(local.blend(F.col("z"), F.col("o").cast("double"), F.lit(0.3)), 6).alias("v"))


@query("L17_version_order", "SELECT p_size % 7 AS a, max(list_value(p_size % 7, p_partkey % 20, p_size)) AS top, count(*) AS n FROM part GROUP BY 1")
def _(spark, d):
    v = F.concat_ws(".", (F.col("p_size") % 7).cast("string"), (F.col("p_partkey") % 20).cast("string"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select((F.col("p_size") % 7).alias("a"), ids.version(v, 3).alias("v")).groupBy("a").agg(F.max("v").cast("array<bigint>").alias("top"), F.count("*").alias("n"))


@query("L18_resolution", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 0.5 WHEN 1 THEN 2.0 WHEN 2 THEN 8.0 END::DOUBLE AS m, CASE p_size % 4 WHEN 0 THEN '50cm' WHEN 1 THEN '2m' WHEN 2 THEN '8m' END AS name FROM part")
def _(spark, d):
    s = F.when(F.col("p_size") % 4 == 0, "0").when(F.col("p_size") % 4 == 1, "2m").when(F.col("p_size") % 4 == 2, "800cm").otherwise("3m")
    m = ids.meters(s)
    return table(spark, d, "part").select("p_partkey", m.alias("m"), ids.resolution_name(m).alias("name"))


_PAIR = "'WV0' || CAST(1 + o_orderkey % 3 AS VARCHAR) || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || lpad(printf('%X', o_orderkey), 16, '0') || '_' || lpad(printf('%X', o_custkey), 16, '0')"


def pairnames(spark, d):
    cat = lambda c: F.lpad(F.hex(F.col(c)), 16, "0")
    name = F.concat_ws("_", F.concat(F.lit("WV0"), (1 + F.col("o_orderkey") % 3).cast("string")), F.date_format("o_orderdate", "yyyyMMdd"), cat("o_orderkey"), cat("o_custkey"))
    return table(spark, d, "orders").withColumn("pair", name)


@query("L19_pairname_parse", f"SELECT o_orderkey, 'WV0' || CAST(1 + o_orderkey % 3 AS VARCHAR) AS sensor, strftime(o_orderdate, '%Y%m%d') AS timestamp, lpad(printf('%X', o_custkey), 16, '0') AS catid2, {_PAIR} AS pair FROM orders")
def _(spark, d):
    p = ids.parse(F.concat("pair", F.lit("_2m_v040201")), "strip_dem")
    q = ids.parse(p["pairname"], "pairname")
    return pairnames(spark, d).select("o_orderkey", q["sensor"].alias("sensor"), q["timestamp"].alias("timestamp"), q["catid2"].alias("catid2"), p["pairname"].alias("pair"))


@query("L20_cross_track", "SELECT o_orderkey, o_orderkey % 2 = 0 AS x FROM orders")
def _(spark, d):
    name = F.when(F.col("o_orderkey") % 2 == 0, "W1W2_20200101").otherwise("WV01_20200101")
    return table(spark, d, "orders").select("o_orderkey", ids.is_cross_track(name).alias("x"))


@query("L21_wkt", "SELECT c_custkey, CAST(c_custkey AS DOUBLE) AS x, CAST(c_nationkey AS DOUBLE) + 0.5 AS y, 3 AS n FROM customer")
def _(spark, d):
    pts = F.array(*[F.struct((F.col("c_custkey") + k).cast("double").alias("x"), (F.col("c_nationkey") + 0.5).alias("y")) for k in range(3)])
    back = geo.from_wkt(geo.to_wkt(pts))
    return table(spark, d, "customer").select("c_custkey", back[0]["x"].alias("x"), back[0]["y"].alias("y"), F.size(back).alias("n"))


@query("L22_corners", "SELECT p_partkey, p_size + 2.0::DOUBLE * 10 AS x, p_retailprice - 2.0::DOUBLE * 5 AS y FROM part")
def _(spark, d):
    gt = geo.geotransform(F.col("p_size").cast("double"), F.lit(2.0), F.col("p_retailprice"), F.lit(-2.0))
    ring = geo.corners(gt, F.lit(5), F.lit(10))
    return table(spark, d, "part").select("p_partkey", ring[2]["x"].alias("x"), ring[2]["y"].alias("y"))


@query("L23_suffix_any", "SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%1' THEN '1' WHEN lower(p_name) LIKE '%2' THEN '2' END AS hit FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", local.any_suffix(F.col("p_name"), ["1", "2"], True).alias("hit"))


@query("L24_rotate_flip", "SELECT 99 - c AS r, r AS c, v FROM g")
def _(spark, d):
    r, c = local.rotate(F.col("r"), F.col("c"), 100, 100, 1)
    return heights(spark, d).select(r.alias("r"), c.alias("c"), "v")


@query("P2_plausible", "SELECT r, c, CASE WHEN v - 50 < -40 OR v = 0 THEN NULL ELSE v END AS z FROM (SELECT r, c, v FROM g) WHERE r < 30")
def _(spark, d):
    return heights(spark, d).where("r < 30").select(*KEY, (local.plausible_height(F.col("v") - 110) + 110).alias("z"))


@query("P3_outlier", "SELECT r, c, v FROM g, (SELECT median(v) AS md, stddev_pop(v) AS sd FROM g) WHERE abs(v - md) <= 3 * sd")
def _(spark, d):
    return stats.outlier_filter(heights(spark, d), "v").select(*KEY, "v")


@query("P4_validrange", "SELECT r, c, v FROM g WHERE v NOT BETWEEN 1 AND 200 AND v <> 0.5")
def _(spark, d):
    return stats.out_of_range(heights(spark, d), "v", 1, 200, 0.5).select(*KEY, "v")


@query("P5_matchtags", "SELECT r, max(m) > 1 AS bad FROM g GROUP BY r")
def _(spark, d):
    return heights(spark, d).groupBy("r").agg((F.max("m") > 1).alias("bad"))


@query("P6_usable_scenes", "SELECT r // 10 AS scene, count(*) AS n FROM g WHERE m = 1 AND z IS NOT NULL GROUP BY 1 HAVING count(*) > 800")
def _(spark, d):
    return heights(spark, d).where("m = 1 and z is not null").groupBy(F.floor(F.col("r") / 10).cast("int").alias("scene")).agg(F.count("*").alias("n")).where("n > 800")


@query("P7_epsg", "SELECT o_orderkey, (32000 + o_orderkey % 900) BETWEEN 32601 AND 32660 OR (32000 + o_orderkey % 900) BETWEEN 32701 AND 32760 AS ok FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", geo.allowed_epsg(32000 + F.col("o_orderkey") % 900).alias("ok"))


@query(
    "meta_problems",
    "SELECT problem, count(*) AS n FROM (SELECT DISTINCT user_id, 'count: ' || k AS problem FROM events, (VALUES ('tdi'), ('min'), ('max'), ('effbw'), ('abscalfact'), ('image'), ('asp_build_id'), ('mean_sun_azimuth_angle'), ('mean_sun_elevation'), ('mean_sat_azimuth_angle'), ('mean_sat_elevation'), ('wv_correct')) AS w(k) WHERE k <> 'tdi' OR user_id % 2 = 0) GROUP BY problem UNION ALL SELECT 'value: tdi', count(DISTINCT user_id) FROM events WHERE user_id % 4 = 1",
)
def _(spark, d):
    users = table(spark, d, "events").select("user_id").distinct()
    twice = users.where("user_id % 2 = 1").select(F.col("user_id").alias("file"), F.explode(F.array(F.lit(1), F.lit(2))).alias("line_no"))
    lines = twice.select("file", "line_no", F.concat(F.lit("image_"), F.col("line_no").cast("string"), F.lit("_tdi")).alias("key"), F.when((F.col("file") % 4 == 1) & (F.col("line_no") == 1), "x").otherwise("16").alias("value"))
    lines = lines.union(users.select("user_id", F.lit(9), F.lit("other"), F.lit("")))
    return check.meta_problems(lines).groupBy("problem").agg(F.count("*").alias("n"))
