"""Every registered query against its reference SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle_check import connect, difference, oracle_table, spark_table

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_points.QUERIES
ORACLE = entry_points.ORACLE_SQL


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_reference_sql_belongs_to_queries():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_reference(spark, connection, name):
    result = spark_table(QUERIES[name](spark, FOLDER))
    assert difference(result, oracle_table(connection, ORACLE[name])) is None


def test_flagship_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_sample_has_the_wanted_month_only(spark):
    rows = QUERIES["sample_month"](spark, FOLDER).select("SOURCE_MONTH").collect()
    assert rows and {row[0] for row in rows} == {"1997-06"}
