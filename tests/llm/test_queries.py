"""Every query of the problems that has SQL is held against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from sonolode.llm import catalog

SQL = catalog.oracle_sql()


def plain(rows):
    return sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, small, name):
    con = duckdb.connect()
    for f in Path(small).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    df = catalog.queries()[name](spark, small)
    columns = sorted(df.columns)
    theirs = con.sql(SQL[name])
    assert sorted(theirs.columns) == columns
    at = [theirs.columns.index(c) for c in columns]
    assert plain(df.select(*columns).collect()) == plain(tuple(r[i] for i in at) for r in theirs.fetchall())
