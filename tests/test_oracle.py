"""Every registered query against its SQL text, run by an independent engine."""

from __future__ import annotations

import os

import duckdb
import pytest

from suite.oracle import ORACLE
from suite.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    expected = oracle.sql(ORACLE[name])
    assert sorted(expected.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    wanted = oracle.sql(f"SELECT {quoted} FROM ({ORACLE[name]})").fetchall()
    got = [tuple(r) for r in found.select(*(f"`{c}`" for c in columns)).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_entry_has_rows(spark):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert os.path.exists(os.path.join(root, "__spark_entry__.py"))
    import __spark_entry__ as entry

    assert not entry.entry(spark).isEmpty()
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())
