"""Queries with SQL twins, over the whole smallest tables."""

import pytest

from tests.compare import connect, duck_rows, same_types, spark_rows
from tonetide.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns, rows = spark_rows(df)
    want_columns, want = duck_rows(duck, ORACLE_SQL[name])
    assert columns == want_columns
    assert not same_types(df, duck, ORACLE_SQL[name])
    assert rows == want and rows
