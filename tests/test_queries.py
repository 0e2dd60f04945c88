"""Every registered query against DuckDB on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tillbridge.plans.oracles import ORACLES
from tillbridge.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert by_name(frame.columns, frame.collect()) == by_name(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
