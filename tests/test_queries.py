"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as contract
from newsloom.plans import catalog

SF_DIR = os.environ.get("NEWSLOOM_TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "pages", "orders", "labels", "embeddings", "benchmark", "conversations")
duckdb = pytest.importorskip("duckdb")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(rows, columns, order):
    places = [columns.index(c) for c in order]
    return sorted((tuple(r[p] for p in places) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_its_sql():
    assert set(catalog.SQL) == set(catalog.QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_sql(spark, sql, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = sql.execute(contract.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    order = sorted(names)
    assert sorted(result.columns) == order
    got = canonical([tuple(r) for r in result.collect()], result.columns, order)
    assert got == canonical(expected.fetchall(), names, order)
    assert got


def test_entry(spark):
    if os.path.isdir(contract.SMOKE_DIR):
        assert contract.entry(spark).count() == 100
