"""Raster tables: scans with pruned bands, sinks by band type, file listings, bundles and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogrid.functions import local

#: Type, nodata and resampling of each band.
BANDS = {"dem": ("float32", -9999.0, "bilinear"), "matchtag": ("uint8", 0.0, "nearest"), "ortho": ("int16", 0.0, "bicubic"), "ortho2": ("int16", 0.0, "bicubic"), "bitmask": ("uint8", 1.0, "nearest")}


def read(spark: SparkSession, path: str, bands: list[str] | None = None, rasters: list[str] | None = None) -> DataFrame:
    """A pixel table; only the bands asked for are read, and only the folders of the rasters asked for."""
    df = spark.read.parquet(path)
    df = df.select("rid", "r", "c", *bands) if bands is not None else df
    return df.where(F.col("rid").isin(*rasters)) if rasters is not None else df


def with_nodata_null(df: DataFrame, bands: dict[str, str]) -> DataFrame:
    """Nodata as null, by the band that each column is: from here on no NaN and no fill value takes part."""
    return df.withColumns({c: local.nodata_to_null(F.col(c), BANDS[b][1]) for c, b in bands.items()})


def write(df: DataFrame, path: str, bands: dict[str, str]) -> None:
    """A pixel table with null as each band's nodata and its stored type, one folder for each raster."""
    cols = {c: local.clip_cast(F.coalesce(F.col(c), F.lit(BANDS[b][1])), local.stored_type(BANDS[b][0])) for c, b in bands.items()}
    df.select("rid", "r", "c", *[x.alias(c) for c, x in cols.items()]).repartition("rid", F.floor(F.col("r") / 1024)).sortWithinPartitions("rid", "r", "c").write.mode("overwrite").partitionBy("rid").parquet(path)


def listing(spark: SparkSession, path: str, least_depth: int = 0, most_depth: int | None = None) -> DataFrame:
    """(path, dir, fname, depth, size, mtime) of files below a folder, at depths from the folder itself (0)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    base = path.rstrip("/").rpartition("/")[2]
    below = F.regexp_extract("path", rf"/{base}/(.*)$", 1)
    depth = F.size(F.split(below, "/")) - 1
    out = files.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", r"([^/]*)$", 1).alias("fname"), depth.alias("depth"), "size", "mtime")
    return out.where((F.col("depth") >= least_depth) & (F.lit(True) if most_depth is None else F.col("depth") <= most_depth))


def write_bundles(tasks: DataFrame, path: str, columns: list[str], delimiter: str = ",") -> None:
    """Tasks (with their bundle number, column task) as one folder of delimited text for each bundle."""
    line = F.concat_ws(delimiter, *[F.col(c).cast("string") for c in columns])
    tasks.select("task", line.alias("value")).repartition("task").write.mode("overwrite").partitionBy("task").text(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Rows (grp, fname, msg) added to a ledger of checked files or errors; readers take the union."""
    rows.select("grp", "fname", "msg", F.current_timestamp().alias("at")).write.mode("append").parquet(path)
