"""Every query with SQL is held against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from sonolode import catalog

SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in Path(small).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(rows):
    return sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, small, db, name):
    df = catalog.queries()[name](spark, small)
    columns = sorted(df.columns)
    ours = plain(df.select(*columns).collect())
    if name not in SQL:
        assert ours
        return
    theirs = db.sql(SQL[name])
    assert sorted(theirs.columns) == columns
    at = [theirs.columns.index(c) for c in columns]
    assert ours == plain(tuple(r[i] for i in at) for r in theirs.fetchall())


def test_entry(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
