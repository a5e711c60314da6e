"""Every raster query with SQL, held against it over the tables of scale 0.01; the others run and give rows."""

import pytest

from orogrid import catalog

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, matches):
    matches(catalog.queries()[name], SQL[name])


SLOW = {"M3_scene_mask", "M2_density_mask", "M4_rough_mask", "M5_mask_8m", "mosaic_segments"}


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL) - SLOW))
def test_query_gives_rows(name, spark):
    assert catalog.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
