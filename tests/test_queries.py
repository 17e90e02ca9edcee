"""Every registered query against its checking SQL on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tools.check import TABLES, rows_of
from workload.registry import ORACLES, QUERIES

from .conftest import SMALL


@pytest.fixture(scope="module")
def checker():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, checker, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    assert got, "a query over full tables gives rows"
    answer = checker.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, answer.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLES) <= set(spark_entry.oracle_sql())


def test_entry_gives_event_records(spark):
    assert spark_entry.entry(spark).columns == ["record_id", "value"]
