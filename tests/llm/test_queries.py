"""Every corpus query against its reference SQL on the given small tables."""

import pytest

from martwright.llm import queries
from tests import oracle_check

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_reference(spark, name):
    ours = oracle_check.spark_table(queries.QUERIES[name](spark, SMALL))
    theirs = oracle_check.oracle_table(oracle_check.connect(SMALL), queries.ORACLE_SQL[name])
    assert oracle_check.difference(ours, theirs) is None


def test_queries_cover_the_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
