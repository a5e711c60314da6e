"""Incremental re-scan: new files in a folder are checked as they appear; the ledger makes repeats harmless."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogrid.sources import rasters


def start(spark: SparkSession, source: str, ledger: str, state: str, check: Callable[[DataFrame], DataFrame], pattern: str = "*.txt"):
    """A query that reads each file below source once and appends check's rows (grp, fname, msg) to the ledger.

    check gets (path, fname, value) of the batch's files. A batch that runs again after a failure is held
    against the ledger first, so its rows come once. Ends when all files present are done."""
    schema = "value string"
    files = spark.readStream.schema(schema).option("wholetext", "true").option("pathGlobFilter", pattern).text(source)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("fname"), "value")

    def each(batch: DataFrame, number: int) -> None:
        rows = check(batch)
        try:
            done = spark.read.parquet(ledger).select("grp", "fname")
            rows = rows.join(done, ["grp", "fname"], "left_anti")
        except Exception as e:  # no ledger yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        rasters.append_ledger(rows, ledger)

    return files.writeStream.foreachBatch(each).option("checkpointLocation", state).trigger(availableNow=True).start()
