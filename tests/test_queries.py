"""Every named query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tableworks.plans.queries import REGISTRY
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
# Training-data queries have tests of their own in tests/llm.
WITHOUT_SQL = sorted(set(REGISTRY) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 7


def test_every_query_has_sql():
    assert WITHOUT_SQL == []
