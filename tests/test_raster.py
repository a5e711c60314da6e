"""Raster operators against plain numpy on small grids, and properties that must hold."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orogrid.functions import geo, ids, local
from orogrid.operators import focal, grid, hull, mosaic, register, resample, stats, tiles, zonal
from orogrid.plans import check, masks
from orogrid.sources import rasters, text


def table(spark, a, name="v"):
    a = np.asarray(a, dtype=object)
    rows = [(0, i, j, None if x is None or (isinstance(x, float) and np.isnan(x)) else float(x)) for (i, j), x in np.ndenumerate(a)]
    return spark.createDataFrame(rows, f"rid int, r int, c int, {name} double")


def array(df, name, shape, cast=float):
    out = np.full(shape, np.nan)
    for x in df.select("r", "c", F.col(name).cast("double")).collect():
        out[x[0], x[1]] = np.nan if x[2] is None else x[2]
    return out


def box(a, k, f):
    lo, hi = k // 2, (k - 1) // 2
    out = np.empty(a.shape)
    for i, j in np.ndindex(a.shape):
        out[i, j] = f(a[max(0, i - lo) : i + hi + 1, max(0, j - lo) : j + hi + 1])
    return out


GRIDS = {
    "delta": np.eye(7)[3][:, None] * np.eye(7)[3],
    "row": np.arange(6.0)[None],
    "column": np.arange(6.0)[:, None],
    "random": np.random.default_rng(1).normal(size=(9, 8)).round(3),
}


@pytest.mark.parametrize("name", GRIDS)
@pytest.mark.parametrize("k", [3, 4, 5])
def test_box_operations(spark, name, k):
    a = GRIDS[name]
    df = table(spark, a)
    np.testing.assert_allclose(array(focal.dilate(df, "v", k, "x"), "x", a.shape), box(a, k, np.max))
    np.testing.assert_allclose(array(focal.erode(df, "v", k, "x"), "x", a.shape), box(a, k, np.min))
    np.testing.assert_allclose(array(focal.moving_average(df, "v", k, "x"), "x", a.shape), box(a, k, np.sum) / k**2, atol=1e-12)


def test_tiles_agree_with_windows(spark):
    a = np.random.default_rng(3).normal(size=(21, 17)).round(3)
    df = table(spark, a)
    t = tiles.to_tiles(df, "v", 8)
    for k in (3, 4, 7):
        np.testing.assert_allclose(array(tiles.to_pixels(tiles.morph(t, k)), "v", a.shape), box(a, k, np.max))
        np.testing.assert_allclose(array(tiles.to_pixels(tiles.morph(t, k, "min")), "v", a.shape), box(a, k, np.min))
        np.testing.assert_allclose(array(tiles.to_pixels(tiles.box_mean(t, k)), "v", a.shape), box(a, k, np.sum) / k**2, atol=1e-9)


def test_null_spreads_over_the_kernel(spark):
    a = np.ones((5, 5), object)
    a[2, 2] = None
    got = array(focal.moving_average(table(spark, a), "v", 3, "x"), "x", (5, 5))
    assert np.isnan(got[1:4, 1:4]).all() and not np.isnan(got[0]).any()
    same = array(focal.moving_average(table(spark, a), "v", 3, "x", nan_same=True), "x", (5, 5))
    assert np.isnan(same).sum() == 1


def test_convolution_full(spark):
    a, k = GRIDS["random"], np.array([[1, 2, 3], [0, -1, 2], [4, 0, 1]])
    want = np.zeros((11, 10))
    for (i, j), w in np.ndenumerate(k):
        want[i : i + 9, j : j + 8] += w * a
    got = focal.convolve(table(spark, a), "v", k.tolist(), "x", shape="full")
    moved = got.select("rid", (F.col("r") + 1).alias("r"), (F.col("c") + 1).alias("c"), "x")
    np.testing.assert_allclose(array(moved, "x", want.shape), want, atol=1e-9)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.booleans(), min_size=6, max_size=6), min_size=5, max_size=5))
def test_erosion_is_dilation_of_the_complement(spark, cells):
    a = np.array(cells, float)
    one = array(focal.erode(table(spark, a), "v", 3, "x"), "x", a.shape)
    two = 1 - array(focal.dilate(table(spark, 1 - a), "v", 3, "x"), "x", a.shape)
    np.testing.assert_array_equal(one, two)


def flood(a, eight=True):
    label, n = np.zeros(a.shape, int), 0
    for s in map(tuple, np.argwhere(a)):
        if label[s]:
            continue
        n += 1
        todo = [s]
        label[s] = n
        while todo:
            i, j = todo.pop()
            for di, dj in [(-1, 0), (1, 0), (0, -1), (0, 1)] + ([(-1, -1), (-1, 1), (1, -1), (1, 1)] if eight else []):
                p = (i + di, j + dj)
                if 0 <= p[0] < a.shape[0] and 0 <= p[1] < a.shape[1] and a[p] and not label[p]:
                    label[p] = n
                    todo.append(p)
    return label


@pytest.mark.parametrize("eight", [True, False])
def test_components(spark, eight):
    for a in (np.random.default_rng(5).random((12, 13)) > 0.5, np.indices((6, 6)).sum(0) % 2 == 0, np.zeros((3, 3), bool), np.ones((3, 3), bool)):
        want = flood(a, eight)
        got = zonal.components(table(spark, a.astype(float)), F.col("v") > 0, 8 if eight else 4).collect()
        assert len(got) == a.sum()
        pairs = {(x.label, want[x.r, x.c], x["size"]) for x in got}
        assert len(pairs) == len({p[0] for p in pairs}) == want.max()
        assert all(size == (want == k).sum() for _, k, size in pairs)


def test_holes(spark):
    a = np.zeros((7, 7))
    a[1:6, 1:6] = 1
    a[3, 3] = 0  # a hole
    a[0, 3] = a[1, 3] = 0  # a bay
    got = array(zonal.fill_holes(table(spark, a).withColumn("f", F.col("v") > 0), "f"), "f", a.shape)
    want = a.copy()
    want[3, 3] = 1
    np.testing.assert_array_equal(got, want)


def test_reconstruct_same_for_any_reach_that_is_three(spark):
    rng = np.random.default_rng(2)
    allowed, seed = rng.random((8, 8)) > 0.4, np.zeros((8, 8))
    seed[4, 4] = 1
    df = table(spark, allowed.astype(float)).join(table(spark, seed, "s"), list(grid.KEY)).withColumns({"ok": F.col("v") > 0, "seed": F.col("s") > 0})
    fast = array(zonal.reconstruct(df, "seed", "ok", 3, "x"), "x", (8, 8))
    cur = box(seed, 3, np.max) * allowed
    while True:
        nxt = box(cur, 3, np.max) * allowed
        if (nxt == cur).all():
            break
        cur = nxt
    np.testing.assert_array_equal(fast, cur)
    slow = array(zonal.reconstruct(df, "seed", "ok", 5, "x"), "x", (8, 8))
    assert (slow >= fast).all() and (slow <= allowed).all()


def test_entropy_of_constant_is_zero(spark):
    got = array(focal.entropy(table(spark, np.full((6, 6), 4.0)), "v", 3), "entropy", (6, 6))
    np.testing.assert_allclose(got, 0, atol=1e-12)


def test_whole_shift_comes_back(spark):
    a = GRIDS["random"]
    df = table(spark, a)
    back = resample.shift(resample.shift(df, "v", 2, -1), "v", -2, 1)
    got = array(back, "v", a.shape)
    ok = ~np.isnan(got)
    assert ok.sum() == 7 * 7 and (got[ok] == a[ok]).all()


def test_registration_finds_a_planted_offset(spark):
    y, x = np.indices((40, 40))
    z = 5 * np.sin(x / 5) + 4 * np.cos(y / 6) + 0.1 * x
    moved = 5 * np.sin((x - 0.3) / 5) + 4 * np.cos((y + -0.2) / 6) + 0.1 * (x - 0.3) + 0.5
    got = register.register(table(spark, z, "z"), table(spark, moved, "z"))
    assert not got.fallback
    np.testing.assert_allclose(got.offset, (0.5, 0.3, -0.2 * -1 * -1), atol=0.05)
    assert got.rmse < 0.05


def test_registration_without_overlap(spark):
    a = np.full((6, 6), None, object)
    got = register.register(table(spark, np.ones((6, 6)), "z"), table(spark, a, "z"))
    assert got.offset is None and got.rmse is None


def test_plane_fit_against_numpy(spark):
    rng = np.random.default_rng(4)
    x1, x2 = rng.normal(size=(2, 200))
    y = 3 + 2 * x1 - x2 + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([(0, float(a), float(b), float(c)) for a, b, c in zip(y, x1, x2, strict=True)], "rid int, y double, a double, b double")
    got = stats.fit_plane(df, "y", "a", "b").first()
    X = np.column_stack([np.ones(200), x1, x2])
    b, rss, *_ = np.linalg.lstsq(X, y, rcond=None)
    np.testing.assert_allclose([got.b0, got.b1, got.b2], b, rtol=1e-8)
    se = np.sqrt(rss[0] / 197 * np.diag(np.linalg.inv(X.T @ X)))
    np.testing.assert_allclose([got.se0, got.se1, got.se2], se, rtol=1e-5)


@pytest.mark.parametrize(("p", "dof", "want"), [(0.975, 10, 2.228139), (0.84, 5, 1.103668), (0.95, 1, 6.313752), (0.84, 1e6, 0.994458)])
def test_t_quantile(p, dof, want):
    assert stats.t_quantile(p, dof) == pytest.approx(want, abs=2e-5)


def test_hulls(spark):
    a = np.zeros((9, 9))
    a[2:7, 2:4] = a[5:7, 2:8] = 1  # an L
    df = table(spark, a).withColumn("f", F.col("v") > 0)
    convex = array(hull.hull_image(df, F.col("f")), "inside", a.shape)
    concave = array(hull.concave_hull_image(df, "f", 0.9), "inside", a.shape)
    assert (convex >= a).all() and (concave >= a).all() and (concave <= convex).all()
    assert convex.sum() > a.sum()


def test_triangles_cover_the_hull_once():
    pts = np.random.default_rng(0).integers(0, 30, (60, 2)).astype(float)
    pts = np.unique(pts, axis=0)
    tri = hull.triangulate(pts)
    u, v = pts[tri[:, 1]] - pts[tri[:, 0]], pts[tri[:, 2]] - pts[tri[:, 0]]
    area = np.abs(u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]).sum() / 2
    ring = hull.convex_ring(pts)
    x, y = ring.T
    whole = abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2
    assert area == pytest.approx(whole, rel=0.02)


def test_decimate_keeps_corners():
    side = [(float(i), 0.0) for i in range(10)] + [(9.0, float(i)) for i in range(1, 10)] + [(float(i), 9.0) for i in range(8, -1, -1)] + [(0.0, float(i)) for i in range(8, 0, -1)]
    got = hull.decimate(np.array(side), 0.5)
    assert {tuple(p) for p in got} == {(0, 0), (9, 0), (9, 9), (0, 9)}


def test_order_scenes():
    rects = [("a", 0, 0, 10, 5), ("b", 8, 0, 18, 5), ("c", 16, 0, 26, 5), ("d", 100, 0, 110, 5)]
    assert mosaic.order_scenes(rects) == (["a", "b", "c"], ["a", "b", "c", "d"])


def test_feather_goes_from_scene_to_strip(spark):
    a = np.zeros((30, 60))
    a[:, :20], a[:, 40:] = 2, 1
    w = array(mosaic.feather_weights(table(spark, a, "a").withColumn("a", F.col("a").cast("int"))), "w", a.shape)
    assert (w[:, :20] == 1).all() and (w[:, 40:] == 0).all()
    assert (np.diff(w[15, 18:42]) <= 1e-9).all()


def test_all_masked_when_too_few_heights(spark):
    df = table(spark, np.full((4, 4), None, object), "z").withColumns({"o": F.lit(50.0), "density": F.lit(1.0)})
    got = masks.cloud_mask(df, k=3, least=2, erode=3, grow_back=3, grow=3, gap=2)
    assert got.where("cloud").count() == 16


def test_empty_tables(spark):
    df = spark.createDataFrame([], "rid int, r int, c int, v double")
    for got in (focal.dilate(df, "v", 3), focal.moving_average(df, "v", 3), zonal.area_open(df.withColumn("f", F.lit(True)), "f", 2), resample.resize(df, "v", 0.5), grid.densify(df), resample.shift(df, "v", 1, 1)):
        assert got.count() == 0


def test_identifiers(spark):
    name = "WV01_20200131_0102030405060708_0A0B0C0D0E0F0001"
    row = spark.range(1).select(
        ids.parse(F.lit(f"ALGO_s2s041_{name}_2m_lsf_seg3"), "strip_segment").alias("seg"),
        ids.parse(F.lit(f"{name}_R1C1-050090123456_01_P001_050090123457_01_P002_2-05"), "scene_dem").alias("scene"),
        ids.parse(F.lit("x" + name), "pairname").alias("bad"),
        ids.version_key(F.lit("4.3.11")).alias("key"),
        ids.pairname(F.lit("WV01"), F.lit("2020"), F.lit("1"), F.lit("2")).alias("no"),
    ).first()
    assert row.seg.pairname == name and row.seg.segnum == "3" and row.seg.lsf == "lsf"
    assert row.scene.res == "2" and row.scene.subtile == "-05"
    assert row.bad is None and row.key == "v040311" and row.no is None


def test_wkt_round_trip(spark):
    pts = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, -1.5), (2e10, 3), (4, 5))])
    row = spark.range(1).select(pts.alias("a"), geo.from_wkt(geo.to_wkt(pts)).alias("b")).first()
    assert row.a == row.b


def test_null_stays_null(spark):
    row = spark.range(1).select(F.lit(None).cast("double").alias("v"))
    got = row.select(local.clip_cast(F.col("v"), "uint8"), local.ramp(F.col("v")), local.quantize(F.col("v")), local.plausible_height(F.col("v")), local.scaled(F.col("v"), 2.0, 1.0, 0.0)).first()
    assert list(got) == [None] * 5


def test_nodata_policies(spark):
    row = spark.createDataFrame([(0.0, False), (5.0, True)], "v double, m boolean")
    v, declared = local.nodata_policy(F.col("v"), F.col("m"), "convert", 0.0, -9.0)
    assert [x[0] for x in row.select(v).collect()] == [-9.0, -9.0] and declared == -9.0
    assert local.nodata_policy(F.col("v"), F.col("m"), "unset", 0.0, -9.0)[1] is None


def test_strip_document_reads_back(spark):
    head = spark.createDataFrame([("s1", "today", "+proj=stere", [0.0, 1.0], [2.0, 3.0], "bitmask", 1.0, 9.0)], "strip_id string, created string, proj4 string, x array<double>, y array<double>, mask string, low double, high double")
    al = spark.createDataFrame([("s1", 1, "a", 0.5, 0.1, 0.2, 0.3, 0.01, 0.02, 0.03), ("s1", 2, "b", None, None, None, None, None, None, None)], "strip_id string, ord int, scene string, rmse double, dz double, dx double, dy double, dz_err double, dx_err double, dy_err double")
    cov = spark.createDataFrame([("s1", 1, "Output Data Density", 0.75), ("s1", 2, "Water Mask Coverage", None)], "strip_id string, ord int, metric string, value double")
    sc = spark.createDataFrame([("s1", 1, "a", "k=v")], "strip_id string, ord int, scene string, meta_text string")
    doc = text.strip_document(head, al, cov, sc)
    lines = doc.select(F.col("strip_id").alias("file"), F.posexplode(F.split("document", "\n")).alias("line_no", "line"))
    got = text.strip_alignment(lines).orderBy("ord").collect()
    assert [(x.scene, x.rmse, x.dy_err) for x in got] == [("a", 0.5, 0.03), ("b", None, None)]
    assert {(x.metric, x.value) for x in text.strip_coverage(lines).collect()} == {("Output Data Density", 0.75), ("Water Mask Coverage", None)}


def test_raster_files(spark, tmp_path):
    df = table(spark, [[1.5, None], [70000.0, -3.0]], "dem").withColumn("rid", F.lit("a"))
    rasters.write(df, str(tmp_path / "r"), {"dem": "dem"})
    back = rasters.with_nodata_null(rasters.read(spark, str(tmp_path / "r"), ["dem"], ["a"]), {"dem": "dem"})
    np.testing.assert_allclose(array(back, "dem", (2, 2)), [[1.5, np.nan], [70000, -3]])
    found = rasters.listing(spark, str(tmp_path / "r"), 1, 1).collect()
    assert found and all(x.depth == 1 for x in found)


def test_check_profiles(spark):
    name = "WV01_20200131_0102030405060708_0A0B0C0D0E0F0001"
    files = spark.createDataFrame([(f"{name}_dem.tif",), (f"{name}_meta.txt",), ("readme",)], "fname string")
    assert {x.part for x in check.missing(files, "pairnames").collect()} == {"matchtag.tif", "ortho.tif"}
    cross = spark.createDataFrame([(f"W1W2_{name[5:]}_{p}",) for p in ("dem.tif", "meta.txt", "matchtag.tif", "ortho.tif")], "fname string")
    assert {x.part for x in check.missing(cross, "pairnames").collect()} == {"ortho2.tif"}


def test_rescan_is_idempotent(spark, tmp_path):
    from orogrid.streaming import rescan

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("ok")
    (src / "b.txt").write_text("bad")
    look = lambda df: df.select(F.lit("g").alias("grp"), "fname", F.col("value").alias("msg"))
    for k in range(2):
        if k:
            (src / "c.txt").write_text("new")
        rescan.start(spark, str(src), str(tmp_path / "ledger"), str(tmp_path / "state"), look).awaitTermination()
    # a lost state folder reads all files again; the ledger keeps rows single
    rescan.start(spark, str(src), str(tmp_path / "ledger"), str(tmp_path / "state2"), look).awaitTermination()
    assert sorted(x.fname for x in spark.read.parquet(str(tmp_path / "ledger")).collect()) == ["a.txt", "b.txt", "c.txt"]


def test_segments_stay_and_bands_move(spark):
    """Two segments of two scenes each, the second of either off by part of a pixel; all are read at the end."""
    from orogrid.operators import mosaic

    rows = []
    shape = lambda r, c: 10 * np.sin(r / 5.0) + 8 * np.cos(c / 6.0) + 3 * np.sin((r + c) / 9.0)
    for name, r0, r1, base, dy, dx in (("a", 0, 40, 0, 0, 0), ("b", 20, 60, 0, 0.4, -0.3), ("c", 0, 40, 300, 0, 0), ("d", 20, 60, 300, -0.3, 0.4)):
        rows += [(name, base + r, c, float(shape(r + dy, c + dx)), 1, 100.0 + r, 1 if (r + c) % 11 == 0 else 0) for r in range(r0, r1) for c in range(40)]
    scenes = spark.createDataFrame(rows, "scene string, r int, c int, z double, m int, o double, md int")
    segments = mosaic.build_segments(scenes, ["a", "b", "c", "d"], 1.0, least_new=100, least_overlap=50, rim=3)
    assert [[x[0] for x in s.alignment] for s in segments] == [["a", "b"], ["c", "d"]]
    for s, base, (dx, dy) in zip(segments, (0, 300), ((0.3, 0.4), (-0.4, -0.3)), strict=True):
        moved = s.alignment[1]
        assert moved[5] == "merged" and moved[3] == pytest.approx(dx, abs=0.1) and moved[4] == pytest.approx(dy, abs=0.1) and all(e is not None for e in moved[6:])
        px = {(r.r - base, r.c): r for r in s.pixels.collect()}  # every segment's table is there
        good = [(k, p) for k, p in px.items() if p.z is not None]
        assert len(good) > 1500
        assert np.median([abs(p.z - shape(*k)) for k, p in good]) < 0.1


def test_moved_bands(spark):
    from orogrid.operators import mosaic

    rng = np.random.default_rng(2)
    o, m, md = rng.integers(50, 90, (20, 24)).astype(float), rng.integers(0, 2, (20, 24)), rng.integers(0, 8, (20, 24))
    rows = [(0, r, c, float(r + c), int(m[r, c]), float(o[r, c]), int(md[r, c])) for r in range(20) for c in range(24)]
    got = {(r.r, r.c): r for r in mosaic.move_scene(spark.createDataFrame(rows, "rid int, r int, c int, z double, m int, o double, md int"), (0.0, 0.75, -0.25), 1.0, rim=3).collect()}
    cubic = lambda t: [((-0.75 * d + 3.75) * d - 6) * d + 3 if d > 1 else (1.25 * d - 2.25) * d * d + 1 for d in (1 + t, t, 1 - t, 2 - t)]
    for r in range(4, 15):
        for c in range(4, 18):
            assert got[r, c].md == md[r, c + 1] and got[r, c].m == m[r, c + 1]  # nearest of (0.25, 0.75)
            assert got[r, c].z == pytest.approx(r + c + 1.0)
            assert got[r, c].o == pytest.approx(np.array(cubic(0.25)) @ o[r - 1 : r + 3, c - 1 : c + 3] @ np.array(cubic(0.75)))
    assert got[0, 23].z is None and got[0, 23].md == 0 and got[19, 23].o is None


def test_numbers_are_a_row_of_numbers(spark):
    from orogrid.operators import relations

    df = spark.createDataFrame([(k % 7, str(k % 3)) for k in range(200)], "a int, b string").repartition(5)
    got = relations.numbered(df, ["a"], 30).collect()
    assert sorted(r.number for r in got) == list(range(200)) and all(r.task == r.number // 30 for r in got)
    assert [r.a for r in sorted(got, key=lambda r: r.number)] == sorted(k % 7 for k in range(200))
