"""Every registered query against its DuckDB SQL on the small tables."""

import os

import pytest

import __spark_entry__ as entry
from ledgerloom.plans.registry import QUERIES
from verification.bank_sql import BANK_SQL
from verification.compare import compare, connect
from verification.star_sql import STAR_SQL

SQL = {**STAR_SQL, **BANK_SQL}

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, SF_DIR, name, QUERIES[name], SQL.get(name))
    assert ok, message


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and SQL.items() <= entry.oracle_sql().items()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
