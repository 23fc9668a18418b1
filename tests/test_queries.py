"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks import oracle, queries as registered

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _plain(rows):
    return sorted(repr(tuple(float(v) if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = _plain(df.select(*columns).collect())
    cursor = duck.execute(oracle.oracle_sql()[name])
    order = sorted(range(len(cursor.description)), key=lambda i: cursor.description[i][0])
    assert [cursor.description[i][0] for i in order] == columns
    want = _plain([r[i] for i in order] for r in cursor.fetchall())
    assert len(got) > 0
    assert got == want


def test_each_query_has_sql():
    assert set(registered.queries()) == set(oracle.oracle_sql())


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() == 6
