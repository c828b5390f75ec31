"""Every registered query against its independent SQL twin, by value."""

import math
import os
from datetime import datetime

import duckdb
import pytest

from tradeloom.oracles import ORACLES
from tradeloom.queries import QUERIES
from tradeloom.sources.sample import TABLE_SCHEMAS

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLE_SCHEMAS:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIRECTORY}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return None if value is None else str(value)


def comparable(rows, positions):
    return sorted(tuple(str(plain(r[i])) for i in positions) for r in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DIRECTORY)
    cursor = duck.execute(ORACLES[name])
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    order = [d[0] for d in cursor.description]
    columns = sorted(df.columns)
    assert columns == sorted(order)
    actual_types = {n: TYPES.get(t, t.upper()) for n, t in df.dtypes}
    assert actual_types == expected_types
    actual = comparable([tuple(r) for r in df.collect()], [df.columns.index(c) for c in columns])
    expected = comparable(cursor.fetchall(), [order.index(c) for c in columns])
    assert len(actual) > 0
    assert actual == expected
