"""Every report query against its SQL, and the plans of all of them."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import DATA, physical_plan

FOLDER = f"{DATA}/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert contract.report_queries().keys() == contract.report_sql().keys()


@pytest.mark.parametrize("name", contract.report_queries())
def test_query_equals_its_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    expected = duck.sql(contract.report_sql()[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    rows = [tuple(row[column] for column in expected.columns) for row in df.collect()]
    assert rows
    assert Counter(rows) == Counter(expected.fetchall())
    plan = physical_plan(df)
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_entry(spark):
    assert contract.entry(spark).count() == 9
