"""Every query with plain SQL gives the rows that SQL gives."""

import math
from collections import Counter
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def counted(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(plain(r[i]) for i in order) for r in data
    )


#: The other queries, if they are there, have tests of their own.
NAMES = sorted({**entry.catalog.QUERIES, **entry.stream_catalog.QUERIES})


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    cursor = duck.execute(entry.oracle_sql()[name])
    want = counted([d[0] for d in cursor.description], cursor.fetchall())
    assert counted(df.columns, df.collect()) == want
    assert sum(want[1].values()) > 0


def test_every_query_has_sql():
    assert set(NAMES) == set(entry.oracle.ORACLE)
    assert set(NAMES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 21
    assert len(df.columns) == 36
