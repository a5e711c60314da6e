"""The supplied tables read as rasters, file lists and metadata; and the same as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; sql may use the tables of PRELUDE."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = PRELUDE + sql
        return f

    return put


#: g: heights with gaps, matches and a value without gaps; o: intensities; box: a 5 x 5 mean surface.
PRELUDE = """WITH g AS (SELECT 0 AS rid, CAST(event_id // 100 AS INTEGER) AS r, CAST(event_id % 100 AS INTEGER) AS c,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS z, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS m, value AS v FROM events),
o AS (SELECT 0 AS rid, CAST(o_orderkey // 100 AS INTEGER) AS r, CAST(o_orderkey % 100 AS INTEGER) AS c, CAST(CAST(floor(o_totalprice) AS BIGINT) % 2048 AS INTEGER) AS o FROM orders)
"""


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def heights(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    i = F.col("event_id")
    return e.select(
        F.lit(0).alias("rid"), F.floor(i / 100).cast("int").alias("r"), (i % 100).cast("int").alias("c"),
        F.when(i % 17 != 0, F.col("value")).alias("z"), F.when(F.col("event_type") == "error", 0).otherwise(1).alias("m"), F.col("value").alias("v"),
    )


def ortho(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(F.lit(0).alias("rid"), F.floor(k / 100).cast("int").alias("r"), (k % 100).cast("int").alias("c"), (F.floor("o_totalprice").cast("long") % 2048).cast("int").alias("o"))


def scene(spark: SparkSession, d: str) -> DataFrame:
    """Heights, matches and intensities on one grid."""
    return heights(spark, d).join(ortho(spark, d), ["rid", "r", "c"], "left")
