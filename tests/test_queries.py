import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from tokenloom.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_entry(spark):
    assert entry.entry(spark).count() == 100


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    text, _, _ = compare(
        spark, connection, SMALL, name, entry.queries()[name], entry.oracle_sql().get(name)
    )
    assert text.startswith("ok"), text
