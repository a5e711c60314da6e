"""All registered raster queries with the SQL that checks them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orogrid.queries import fixtures

for _name in ("local_queries", "focal_queries", "relation_queries", "mask_queries"):
    importlib.import_module(f"orogrid.queries.{_name}")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.QUERIES["bitmask_report"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(fixtures.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(fixtures.ORACLES)
