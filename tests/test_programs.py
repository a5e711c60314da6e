"""Programs end to end on small tables."""

import numpy as np
from pyspark.sql import functions as F

from orogrid.__main__ import main
from orogrid.plans import programs


def surface(spark, rows, cols, dz=0.0):
    y, x = np.indices((rows, cols))
    z = 5 * np.sin(x / 5) + 4 * np.cos(y / 6) + 0.1 * x + dz
    return spark.createDataFrame([(0, int(i), int(j), float(z[i, j])) for i, j in np.ndindex(z.shape)], "rid int, r int, c int, z double")


def test_diff(spark, tmp_path, capsys):
    surface(spark, 30, 30).write.parquet(str(tmp_path / "a"))
    surface(spark, 30, 30, 1.5).write.parquet(str(tmp_path / "b"))
    assert main(["diff", str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "d"), "--cell", "1", "--window", "20", "20"], spark) == 0
    worst = spark.read.parquet(str(tmp_path / "d")).where("dz is not null").agg(F.max(F.abs("dz"))).first()[0]
    assert worst < 0.05 and "offset" in capsys.readouterr().out


def test_mask_and_apply(spark, tmp_path):
    df = surface(spark, 24, 24).withColumns({"m": F.lit(1), "o": (F.col("c") % 7) * 10.0 + 21})
    df.write.parquet(str(tmp_path / "s"))
    assert main(["mask", str(tmp_path / "s"), str(tmp_path / "m"), "--sun", "40", "--version", "mask8m"], spark) == 0
    mask = spark.read.parquet(str(tmp_path / "m"))
    assert mask.count() == 24 * 24
    half = mask.where("r < 12 and c < 12").withColumn("mask", F.when(F.col("r") < 6, 1).otherwise(0))  # a mask at half the resolution
    got = programs.mask_bands(df, half, ["edge"], {"z": None, "m": 0})
    assert got.where("z is null").agg(F.max("r")).first()[0] == 11 and got.where("m = 0").count() == 12 * 24


def test_strips(spark, tmp_path, capsys):
    s = surface(spark, 40, 24)
    parts = [s.where(f"r between {a} and {a + 24}").select(F.lit(n).alias("scene"), "r", "c", (F.col("z") + up).alias("z"), F.lit(1).alias("m"), F.lit(5.0).alias("o"), F.lit(0).alias("md")) for n, a, up in (("s1", 0, 0.0), ("s2", 14, 0.5))]
    parts[0].union(parts[1]).write.parquet(str(tmp_path / "in"))
    assert main(["strips", str(tmp_path / "in"), str(tmp_path / "out"), "--cell", "1", "--least-new", "50", "--least-overlap", "50"], spark) == 0
    assert "merged" in capsys.readouterr().out
    z = spark.read.parquet(str(tmp_path / "out/seg1")).select("r", "c", F.col("z").alias("got")).where("got is not null")
    assert z.join(s, ["r", "c"]).agg(F.max(F.abs(F.col("got") - F.col("z")))).first()[0] < 0.6


def test_resample_and_check(spark, tmp_path, capsys):
    surface(spark, 20, 20).withColumn("m", F.lit(1)).write.parquet(str(tmp_path / "s"))
    assert main(["resample", str(tmp_path / "s"), str(tmp_path / "r"), "--factor", "0.5", "--bands", "z=dem", "m=matchtag"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "r")).where("z is not null and m = 1").count() == 100
    tree = tmp_path / "tree"
    tree.mkdir()
    (tree / "WV01_20200131_0102030405060708_0A0B0C0D0E0F0001_dem.tif").write_text("x")
    assert main(["check", str(tree), "--profile", "pairnames"], spark) == 1
    assert "meta.txt: missing in 1 groups" in capsys.readouterr().out


def test_browse(spark):
    df = surface(spark, 20, 20).withColumns({"m": F.lit(1), "o": F.lit(7.0), "mask": F.when(F.col("r") < 10, 4).otherwise(0)})
    got = programs.browse(df, 0.5)
    assert got.count() == 100 and got.where("z_masked is null").count() == 50 and got.where("shade is not null").count() == 64
