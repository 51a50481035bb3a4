"""Every query against its SQL, on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = df.collect()
    assert got, "no rows"
    if name not in ORACLES:
        return
    wanted = duck.execute(ORACLES[name])
    names = [d[0] for d in wanted.description]
    assert sorted(df.columns) == sorted(names)
    place = [names.index(c) for c in df.columns]
    left = Counter(tuple(cell(v) for v in row) for row in got)
    right = Counter(tuple(cell(row[i]) for i in place) for row in wanted.fetchall())
    assert left == right


def test_every_query_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
