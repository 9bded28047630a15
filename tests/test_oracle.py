"""Every registered query against its SQL in a second engine, over the whole given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = ordered(tuple(r[c] for c in columns) for r in df.collect())
    assert ours
    text = contract.oracle_sql().get(name)
    if text is None:
        return
    result = duck.execute(text)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = ordered(tuple(dict(zip(names, r))[c] for c in columns) for r in result.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert contract.entry(spark).count() == 200


def test_every_query_has_an_oracle():
    names = set(contract.queries()) - set(contract.LLM_QUERIES)
    assert names - set(contract.oracle_sql()) == set()
