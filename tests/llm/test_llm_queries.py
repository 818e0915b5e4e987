import os

import pytest
from against_sql import SF, compare

from pagewright.llm import queries, sql

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_equals_sql(spark, name):
    compare(spark, queries.QUERIES[name], sql.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(sql.SQL)))
def test_runs_on_the_smallest_tables(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)
