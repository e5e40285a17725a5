"""Every query gives the rows of its SQL counterpart in DuckDB."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pitwall.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def _normal(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert _normal(df.collect(), df.columns) == _normal(cursor.fetchall(), columns)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["session_key", "driver_number", "laps", "median_lap_ms", "pace_ratio"]
    assert df.count() == 15
