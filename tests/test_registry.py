"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from parity import connect, digest, duck_result, same_types, spark_result
from tradewind.registry import oracles, queries

QUERIES, SQL = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_parity(spark, duck, name):
    columns, got, kinds = spark_result(QUERIES[name](spark, SMALL))
    assert len(set(columns)) == len(columns)
    if name in SQL:
        duck_columns, want, duck_kinds = duck_result(duck, SQL[name])
        assert digest(columns, got) == digest(duck_columns, want)
        assert same_types(kinds, duck_kinds)


def test_flagship(spark):
    assert entry.entry(spark).count() == 10
