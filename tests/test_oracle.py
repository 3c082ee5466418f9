"""Every query with SQL gives the rows that DuckDB gives."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from leadweave.plans import all_sql


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for f in os.listdir(small):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{small}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_same_rows(spark, small, duck, name):
    df = entry.queries()[name](spark, small)
    cols = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*cols).collect())
    sql = entry.oracle_sql()[name]
    assert cols == sorted(duck.sql(sql).columns)
    assert got == Counter(duck.sql(f"SELECT {', '.join(cols)} FROM ({sql}) z").fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
