"""Written intermediates for iterative plans: lineage stays short and a lost executor costs one round."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set, a temporary one, but only if all threads run on this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if path is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            path = f"{sc._jvm.System.getProperty('java.io.tmpdir')}/orogrid-{uuid.uuid4().hex}"
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


class Rounds:
    """Keeps the last table of an iteration in the shared folder and removes the one before it. What is left goes with the driver."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.k = spark, f"{shared_dir(spark)}/rounds-{uuid.uuid4().hex}", 0
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.base)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{self.k}"
        df.write.mode("overwrite").parquet(path)
        if self.k > 1:  # the table before the last is not read any more
            jvm = self.spark.sparkContext._jvm
            old = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{self.k - 2}")
            old.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
        self.k += 1
        return self.spark.read.schema(df.schema).parquet(path)
