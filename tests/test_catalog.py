"""Every driver query against its oracle on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import catalog

SF_DIR = "/root/testdata/sf0.001"
catalog.load_all()
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not there")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(cell):
    if isinstance(cell, float):
        return None if math.isnan(cell) else round(cell, 6)
    return cell


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = tables.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
