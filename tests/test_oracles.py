"""Every registered query equals its SQL on the same tables."""

import pytest
from check import assert_same, expected

from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    actual = queries()[name](spark, sf_dir).toArrow()
    assert actual.num_rows > 0
    assert_same(actual, expected(oracle_sql()[name], sf_dir))


def test_every_query_has_sql():
    assert set(queries()) - set(LLM_QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
