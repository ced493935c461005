"""Queries that SQL can express, against their SQL."""

from __future__ import annotations

import pytest

from tests.oracle_check import actual, duck, expected
from tiermill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.STATEMENTS))
def test_query_matches_sql(spark, small, name):
    assert actual(queries.QUERIES[name](spark, small)) == expected(duck(small), queries.STATEMENTS[name])
