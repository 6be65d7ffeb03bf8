"""Every query with an SQL form gives the same rows in DuckDB on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import connect, differences

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())


@needs_tables
@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_rows(spark, con, name):
    assert differences(spark, con, SF, name, queries()[name], oracle_sql()[name]) == []


@needs_tables
@pytest.mark.parametrize("name", [n for n in queries() if n not in oracle_sql()])
def test_gives_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


@needs_tables
def test_entry(spark):
    assert entry(spark).count() > 0
