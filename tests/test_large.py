"""Rasters that are long, and queries on grids of other sizes than the SQL's own."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from orogrid import catalog
from orogrid.operators import hull, register, stats, zonal


def test_long_strips_are_triangulated_in_time(spark):
    n = 20_000
    g = np.random.default_rng(2)
    pts = np.unique(np.column_stack([np.repeat(np.arange(n), 2), np.column_stack([g.geometric(0.5, n), 99 - g.geometric(0.5, n)]).ravel()]), axis=0).astype(float)
    start = time.monotonic()
    tri = hull.triangulate(pts)
    assert time.monotonic() - start < 30
    a, b, c = pts[tri[:, 0]], pts[tri[:, 1]], pts[tri[:, 2]]
    area = np.abs((b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])).sum() / 2
    ring = hull.convex_ring(pts)
    whole = abs((ring[:, 0] * np.roll(ring[:, 1], -1) - np.roll(ring[:, 0], -1) * ring[:, 1]).sum()) / 2
    assert area == pytest.approx(whole, rel=1e-3)


def _flood(on, steps):
    label = np.full(on.shape, -1)
    for i, j in np.argwhere(on):
        if label[i, j] < 0:
            todo = [(i, j)]
            label[i, j] = i * on.shape[1] + j
            while todo:
                r, c = todo.pop()
                for dr, dc in steps:
                    y, x = r + dr, c + dc
                    if 0 <= y < on.shape[0] and 0 <= x < on.shape[1] and on[y, x] and label[y, x] < 0:
                        label[y, x] = i * on.shape[1] + j
                        todo.append((y, x))
    return label


@pytest.mark.parametrize("connectivity", [4, 8])
@pytest.mark.parametrize("rounds", [False, True])
def test_components_over_blocks(spark, connectivity, rounds, monkeypatch):
    """Parts of several blocks are joined without rounds; with nothing held by one task, the rounds give the same."""
    on = np.random.default_rng(3).random((30, 40)) < (0.6 if connectivity == 4 else 0.42)
    on[12, :] = on[:, 20] = True
    if rounds:
        monkeypatch.setattr(zonal, "MOST_HELD", -1)
    else:
        monkeypatch.setattr(zonal, "_star_rounds", None)
    # the middle of the grid is a corner of four blocks
    df = spark.createDataFrame([(0, 1024 - 15 + int(i), 1024 - 20 + int(j), bool(on[i, j])) for i, j in np.ndindex(on.shape)], "rid int, r int, c int, f boolean")
    got = np.full(on.shape, -1)
    size = np.zeros(on.shape, int)
    for x in zonal.components(df, F.col("f"), connectivity).collect():
        i, j = x.r - 1024 + 15, x.c - 1024 + 20
        got[i, j], size[i, j] = ((x.label >> 32) - 1024 + 15) * on.shape[1] + (x.label & 0xFFFFFFFF) - 1024 + 20, x["size"]
    want = _flood(on, [(0, 1), (0, -1), (1, 0), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if connectivity == 8 else []))
    assert (got == want).all()
    assert all((size[want == k] == (want == k).sum()).all() for k in np.unique(want[on]))


def test_registration_computes_its_grids_once(spark):
    """Rounds read what is written: the grids, however they are made, are not made again in each round."""
    y, x = np.indices((40, 40))
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            made.add(len(pdf))
            yield pdf

    def grid(z):
        rows = [(0, int(i), int(j), float(z[i, j])) for i, j in np.ndindex(z.shape)]
        return spark.createDataFrame(rows, "rid int, r int, c int, z double").mapInPandas(count, "rid int, r int, c int, z double")

    z = 5 * np.sin(x / 5) + 4 * np.cos(y / 6) + 0.1 * x
    moved = 5 * np.sin((x - 0.3) / 5) + 4 * np.cos((y - 0.2) / 6) + 0.1 * (x - 0.3) + 0.5
    got = register.register(grid(z), grid(moved))
    np.testing.assert_allclose(got.offset, (0.5, 0.3, -0.2), atol=0.05)
    assert got.rounds > 1 and made.value == 2 * z.size


@pytest.mark.parametrize("n", [1, 2, 3, 10, 11, 4000, 4001])
def test_medians_are_exact(spark, n):
    g = np.random.default_rng(n)
    values = [g.normal(size=n), g.integers(0, 3, n).astype(float), np.full(n, 2.5), np.repeat([-1.0, 4.0], n)]
    rows = [(k, float(v)) for k, vs in enumerate(values) for v in vs] + [(0, None), (9, None)]
    got = dict(map(tuple, stats.medians(spark.createDataFrame(rows, "rid int, v double"), "v").collect()))
    assert got.keys() == {0, 1, 2, 3}
    assert all(got[k] == np.median(vs) for k, vs in enumerate(values))


#: Queries whose SQL fixes rows and columns 0 to 99.
FRAMED = ["A13_best_window", "G1_bilinear", "G1_nearest", "W7_gradient", "F10_fill_holes", "F14_entropy", "F1_conv_valid", "F4_box_mean_replicate", "G1_bicubic"]


@pytest.mark.parametrize("name", FRAMED)
def test_framed_queries_match_sql_on_longer_rasters(name, spark, tmp_path):
    """The heights of scale 0.01 three times over, two more pixels, and matches everywhere in what is added."""
    import duckdb

    con = duckdb.connect()
    con.execute(f"copy (select e.* replace (event_id + 10000 * k as event_id, case when k > 0 then 'view' else event_type end as event_type) from '/root/testdata/sf0.01/events.parquet' e, range(4) x(k) where event_id + 10000 * k < 30002) to '{tmp_path}/events.parquet' (format parquet)")
    for t in ("events", "orders"):
        con.execute(f"create view {t} as select * from '{tmp_path if t == 'events' else '/root/testdata/sf0.01'}/{t}.parquet'")
    plain = lambda row: tuple(round(x, 5) + 0.0 if isinstance(x, float) else x for x in row)
    res = con.execute(catalog.oracle_sql()[name])
    cols = [x[0] for x in res.description]
    want = sorted(map(plain, res.fetchall()), key=str)
    got = sorted(map(plain, catalog.queries()[name](spark, str(tmp_path)).select(*cols).collect()), key=str)
    assert got == want
