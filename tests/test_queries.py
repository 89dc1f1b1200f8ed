"""Every query with SQL gives the same rows in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from tidepanel.plans import queries as Q

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return db


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) + 0.0 if isinstance(v, float) else str(v)[:10] if hasattr(v, "year") else v


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=lambda r: [(x is None, str(type(x)), x or 0) for x in r])


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    got = Q.queries()[name](spark, SMALL)
    want = duck.sql(Q.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert ordered(got.columns, got.collect()) == ordered(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
