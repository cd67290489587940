"""Queries that SQL can express equal it."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import oracle  # noqa: E402

from tessera.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    assert oracle.difference(queries.queries()[name](spark, oracle.DATA), queries.oracle_sql()[name]) is None


def test_one_query_an_operator():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{k}" for k in range(1, 14)]
