import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from orogrid.ship import ship

    ship(s)
    yield s
    s.stop()


DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


@pytest.fixture
def matches(spark, duck):
    """Holds a Spark query against its SQL over the tables of scale 0.01."""

    def check(f, sql):
        df = f(spark, "/root/testdata/sf0.01")
        cols = sorted(df.columns)
        got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
        res = duck.execute(sql)
        names = [x[0] for x in res.description]
        assert sorted(names) == cols
        want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=str)
        assert len(got) == len(want)
        assert got == want

    return check
