"""Every registered query against its SQL counterpart in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from billwright.checks.oracle import ORACLE_SQL
from billwright.checks.queries import QUERIES
from conftest import DATA, bag

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    theirs = duck.execute(ORACLE_SQL[name])
    columns = [column[0] for column in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = sorted(theirs.fetchall(), key=lambda row: [(v is None, str(v)) for v in row])
    assert bag(ours.select(*[f"`{column}`" for column in columns])) == expected
    assert expected


def test_entry(spark):
    assert entry.entry(spark).count() == 69
