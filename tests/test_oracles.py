"""Every catalogue query on the smallest tables against its SQL in DuckDB."""

import math

import duckdb
import pytest

from ledgerloom.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def key(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted(tuple(key(r[c]) for c in names) for r in df.collect())
    done = duck.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in done.description]
    assert sorted(columns) == names
    assert got == sorted(tuple(key(dict(zip(columns, r, strict=True))[c]) for c in names) for r in done.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 20
    assert set(e.oracle_sql()) <= set(e.queries())
