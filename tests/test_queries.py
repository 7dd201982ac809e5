"""Every registered query runs; those with SQL give the same rows as DuckDB."""

import math
import os

import pytest

import __spark_entry__ as entry_points
from miasma.plans import catalogue

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def table(columns, rows):
    """Column names and sorted rows, columns in name order, values as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    return ([columns[i] for i in order],
            sorted(tuple(text(row[i]) for i in order) for row in rows))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    got = table(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got[1] == expected[1]


def test_every_query_of_the_library_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
