"""Every query that SQL can express, against DuckDB on the smallest tables."""

import pytest

import check
from scoreloom import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_query_equals_sql(spark, con, name):
    rows, difference = check.compare(con, spark, name, FOLDER)
    assert difference == ""
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(catalog.oracles()) <= set(catalog.queries())
