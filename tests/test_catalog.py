"""Every query against its SQL twin, over the whole smallest tables."""

import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, duck_rows, same_types, spark_rows
from tonetide.catalog import QUERIES

SF = "/root/testdata/sf0.001"

# Every inventory id that stands for something to run.
INVENTORY = (
    "S1 S2 S3 S4 S5 S6 S7 S8 S9 S10 K1 K2 K3 K4 K5 K6 P1 P2 P3 P4 P5 P6 P7 P8 P9 J1 J2 J3 J4 J5 "
    "A1 A2 A3 A4 A5 A6 A7 A8 O1 O2 O3 F1 F1b F2 F3 F4 F5 F6 F7 F8 F9 F10 F11 "
    "T1 T2 T3 T4 T5 T6 T7 T8 T9 T10 T11 M1 M2 M3 M4 M5 M6 M7 M8 M9 U1 U2 U3"
).split()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    query = QUERIES[name]
    df = query.run(spark, SF)
    columns, rows = spark_rows(df)
    assert rows
    if query.sql is None:
        return
    want_columns, want = duck_rows(duck, query.sql)
    assert columns == want_columns
    assert not same_types(df, duck, query.sql)
    assert rows == want


def test_every_operator_has_a_query():
    covered = {c for q in QUERIES.values() for c in q.covers}
    assert set(INVENTORY) <= covered
    assert covered <= set(INVENTORY)


def test_entry_points(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).columns == ["lang", "Positive", "Negative"]
