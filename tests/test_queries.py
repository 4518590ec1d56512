"""Every registered query against its SQL, and the driver contract."""

import os

import __spark_entry__ as entry_module
import pytest
from compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and {r["status"] for r in rows} >= {"INCOMPLETE", "WEEKEND"}
