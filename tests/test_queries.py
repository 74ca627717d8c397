"""Every registered query, against its SQL where it has one."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, QUERIES[name], ORACLES[name], SF_DIR) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, name):
    assert len(QUERIES[name](spark, SF_DIR).collect()) > 0


def test_entry(spark):
    table = entry.entry(spark)
    assert len(table.columns) == 29 and table.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_lists_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
