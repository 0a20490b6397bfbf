"""Every registered query against its SQL in another engine, over the smallest data folder."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from limpid.catalog import load

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def _sortable(row):
    return tuple(
        (x is None, str(type(x)), 0 if x is None else (-math.inf if isinstance(x, float) and math.isnan(x) else x))
        for x in row
    )


def test_every_query_has_sql():
    assert set(SQL) <= set(QUERIES)
    assert not [name for name in load().QUERIES if name not in SQL]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, duck):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    names = sorted(df.columns)
    assert names == sorted(c[0] for c in cursor.description)
    order = [[c[0] for c in cursor.description].index(n) for n in names]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_sortable)
    found = sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=_sortable)
    assert found == expected


def test_ordered_queries_keep_their_order(spark, duck):
    for name in ("sort_by_keys", "topk", "report_sorted", "metric_display_order", "top20_values", "preview_n"):
        df = QUERIES[name](spark, SF_DIR)
        cursor = duck.execute(SQL[name])
        order = [[c[0] for c in cursor.description].index(c) for c in df.columns]
        assert [tuple(r) for r in df.collect()] == [tuple(r[i] for i in order) for r in cursor.fetchall()], name


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).count() == 6
