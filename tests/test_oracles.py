"""Every registered query against its SQL twin in DuckDB."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from strataroll.plans.oracles import ORACLES
from strataroll.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f.removesuffix(".parquet") for f in sorted(os.listdir(SF_DIR))]


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(comparable(row[i]) for i in order) for row in rows)


# SQL type names of the two engines side by side.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sql, name):
    frame = contract.queries()[name](spark, SF_DIR)
    relation = sql.sql(contract.oracle_sql()[name])
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SAME_TYPE[t] for c, t in frame.dtypes} == expected_types
    got = multiset(frame.columns, frame.collect())
    expected = multiset(relation.columns, relation.fetchall())
    assert sum(expected.values()) > 0
    assert not (got - expected) and not (expected - got)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
