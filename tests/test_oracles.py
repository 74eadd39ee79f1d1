"""Every registered query against its SQL on the given tables."""

import glob
import os

import pytest

import __spark_entry__ as entry_points
from clickmill.plans.oracles import ORACLES
from clickmill.plans.registry import QUERIES

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, tables, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = tables.execute(ORACLES[name])
    order = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(order)
    ours = sorted((repr(tuple(r[c] for c in order)) for r in found.collect()))
    assert ours == sorted(repr(r) for r in expected.fetchall())


def test_the_flagship(spark):
    assert entry_points.entry(spark).count() > 0
