import __spark_entry__ as entry
import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
CORE = [k for k in entry.oracle_sql() if k[0] != "p" or k.startswith(("p4", "pay"))]


def rows(df):
    import datetime as dt

    def plain(x):
        if x is None or (isinstance(x, float) and x != x):
            return "~"
        if isinstance(x, bool):
            return str(x)
        if isinstance(x, (int, float)):
            return repr(round(float(x), 5))
        return str(x if not isinstance(x, dt.datetime) else x.isoformat())

    return sorted(tuple(plain(x) for x in r) for r in df)


@pytest.fixture(scope="module")
def con():
    import glob
    import os

    c = duckdb.connect()
    c.sql("SET timezone='UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_against_sql(spark, con, name):
    got = entry.queries()[name](spark, DATA)
    names = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert rows(got.select(*names).collect()) == rows(want)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
