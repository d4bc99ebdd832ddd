"""Every registered query against its SQL on the same tables."""

import __spark_entry__ as entry_point
import pytest
from checks import compare, duck

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(entry_point.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    frame = entry_point.queries()[name](spark, FOLDER)
    difference, rows = compare(frame, connection, entry_point.oracle_sql()[name])
    assert not difference
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry_point.queries()[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 6_000
