"""Every registered query against its SQL in DuckDB, over the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(name, spark, duck):
    df = entry.queries()[name](spark, FOLDER)
    found = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.columns, [tuple(r) for r in df.collect()]) == _sorted(columns, found.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns


def test_queries_without_sql_run(spark):
    for name in set(entry.queries()) - set(entry.oracle_sql()):
        assert entry.queries()[name](spark, FOLDER).columns
