"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from folioforge.plans import catalog

SF = "/root/testdata/sf0.001"
KEYS = list(catalog.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(str(x) if x == x and x is not None else "-" for x in r) for r in frame[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, duck, key):
    assert rows(catalog.queries()[key](spark, SF).toPandas()) == rows(duck.sql(catalog.oracle_sql()[key]).df())


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_fixtures_read_every_order(spark, duck):
    """Table and guard queries see all lines, not those of chosen order keys."""
    orders, items = duck.sql("SELECT count(DISTINCT l_orderkey), count(*) FROM lineitem").fetchall()[0]
    assert catalog.queries()["d04_row_anchors"](spark, SF).count() == orders
    assert catalog.queries()["n10_table_rows"](spark, SF).where("row_no > 1").count() == items
