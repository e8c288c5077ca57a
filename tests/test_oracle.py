"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = list(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    fn = E.queries()[key]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert fn(spark, SF).count() >= 0
        return
    r = compare(spark, key, fn, sql, SF, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["workbook", "Year", "Platform_Name", "Month", "Unplanned_Value",
                          "Metered_Value", "Result"]
    assert df.count() > 0
