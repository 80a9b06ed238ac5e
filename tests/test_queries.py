"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, entry.queries()[name], entry.oracle_sql().get(name)) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
