"""Every registered query against its SQL, rows and values, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, own_queries
from checks.compare import difference, duck, expected_of


@pytest.fixture(scope="module")
def connection():
    return duck(SMOKE_DIR)


def test_every_query_has_its_sql():
    assert own_queries().keys() <= oracle_sql().keys()


def test_entry_gives_rows(spark):
    assert entry(spark).count() == 182


@pytest.mark.parametrize("name", own_queries())
def test_rows_equal_the_sql(spark, connection, name):
    assert difference(own_queries()[name](spark, SMOKE_DIR), expected_of(connection, oracle_sql()[name])) is None
