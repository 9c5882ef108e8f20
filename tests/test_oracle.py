"""Every query that SQL can express, against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry
from check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    master = entry.entry(spark)
    assert master.count() == 150
    assert {"R_score", "F_score", "M_score", "RFM_score", "value_segment"} <= set(master.columns)


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
