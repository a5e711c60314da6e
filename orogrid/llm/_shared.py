"""Written intermediates in the folder that all executors share, and small column helpers."""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock, _writers, _before = threading.Lock(), Counter(), {}
_owners: list[list[Scratch]] = []


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


@contextmanager
def _short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """While any write of this process lasts, shuffle files go when the query that made them has ended."""
    with _lock:
        if not _writers[id(spark)]:
            _before[id(spark)] = spark.conf.get(CLEANUP, "false")
        _writers[id(spark)] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _writers[id(spark)] -= 1
            if not _writers[id(spark)]:
                spark.conf.set(CLEANUP, _before.pop(id(spark)))


@contextmanager
def owned() -> Iterator[None]:
    """Removes what was written within when it ends: for callers that have written the result by then."""
    made: list[Scratch] = []
    _owners.append(made)
    try:
        yield
    finally:
        _owners.remove(made)
        for scratch in made:
            scratch.drop()


class Scratch:
    """Tables written once and read again: cuts lineage, survives lost executors, computes nothing twice.

    What is left of them goes with the driver, or with the `owned` block in which they were made."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.made = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}", {}
        folder, files = self._files(self.base)
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        if _owners:
            _owners[-1].append(self)

    def _files(self, path: str):
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(sc._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and reads it back; the shuffle files of the write go when it has ended."""
        path = f"{self.base}/{name}"
        with _short_lived_shuffles(self.spark):
            df.write.mode("overwrite").parquet(path)
        self.made[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes written tables that nothing reads any more (none named: all)."""
        for name in names or tuple(self.made):
            folder, files = self._files(self.made.pop(name))
            files.delete(folder, True)
        if not names:
            folder, files = self._files(self.base)
            files.delete(folder, True)


def hex64(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def offsets(lengths: Column) -> Column:
    """For an array of lengths, the sum of those before each. In blocks of the root of its size, so that the
    arrays that grow by one element stay short: n ** 1.5 steps."""
    none = F.array().cast("array<int>")

    def block(a: Column, begin: Column, width: Column, all_: Column) -> Column:
        first = F.struct(a["sum"].alias("sum"), none.alias("out"))
        inner = F.aggregate(F.slice(all_, begin + 1, width), first, lambda b, x: F.struct((b["sum"] + x).alias("sum"), F.array_append(b["out"], b["sum"]).alias("out")))
        # an array of one holds the inner result, so that it is computed once
        return F.get(F.transform(F.array(inner), lambda v: F.struct(v["sum"].alias("sum"), F.concat(a["out"], v["out"]).alias("out"))), 0)

    def whole(all_: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_))).cast("int")
        start = F.struct(F.lit(0).alias("sum"), none.alias("out"))
        return F.when(F.size(all_) > 0, F.aggregate(F.sequence(F.lit(0), F.size(all_) - 1, width), start, lambda a, b: block(a, b, width, all_))["out"]).otherwise(none)

    return F.get(F.transform(F.array(lengths), whole), 0)
