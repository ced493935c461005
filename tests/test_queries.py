from __future__ import annotations

import __spark_entry__ as entry
import pytest

from tests.oracle_check import actual, duck, expected

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(entry.QUERIES) == set(entry.STATEMENTS)


def test_entry_returns_the_sales_fact(spark):
    assert entry.entry(spark).count() == 6000


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_sql(spark, name):
    assert actual(entry.queries()[name](spark, SMALL)) == expected(duck(SMALL), entry.oracle_sql()[name])
