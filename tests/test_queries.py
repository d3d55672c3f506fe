"""Every registered query against its SQL, on the smallest sample tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from usagelens.plans.registry import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="sample tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(x):
        return "NULL" if x is None or (isinstance(x, float) and math.isnan(x)) else str(x)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, str(SF_DIR))
    result = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert normal(df.columns, df.collect()) == normal(names, result.fetchall())
