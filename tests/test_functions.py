"""Scalar edge semantics (F-01..F-14, S-06, S-07) on small DataFrames."""

import math

from pyspark.sql import functions as F

from cellfold.functions.metrics import (completion_pct, efficiency_pct, guarded_percent,
                                        numeric_read, numeric_read_error, string_read,
                                        text_percent)
from cellfold.functions.text import (arith_text_eval, blank_to_zero_int, jtrim, label_key,
                                     norm_key, parse_int_strict)


def _col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_java_trim_and_keys(spark):
    assert _col(spark, ["\x00\t a b \x1f", " ", None], jtrim) == ["a b", "", None]
    assert _col(spark, [" Total\tX \r\n", None], norm_key) == ["total\tx", ""]
    assert label_key("  Location\t") == "location"


def test_strict_int_and_blank_to_zero(spark):
    got = _col(spark, ["5", "+5", "-12", "5.0", "1,200", "", "99999999999", " 7 "],
               parse_int_strict)
    assert got == [5, 5, -12, None, None, None, None, None]
    assert _col(spark, ["", "  ", "3", "x"], blank_to_zero_int) == [0, 0, 3, None]


def test_arith_text(spark):
    got = _col(spark, ["52 + 3", "7 - 9", "6 * 7", "1 + 2 + 3", "4", "3 / 4", "a + 1", "",
                       "2147483647 + 1"], arith_text_eval)
    assert got == [55, -2, 42, 4, 4, None, None, None, None]


def test_text_percent(spark):
    got = _col(spark, ["0.876", "-0.2", ".5", "1e-1", " 0.5", "abc", "0.125", "0.665"],
               text_percent)
    assert got[:4] == [88.0, 0.0, 50.0, 10.0]
    assert math.isnan(got[4]) and math.isnan(got[5])     # BigDecimal rejects blanks
    assert got[6:] == [13.0, 67.0]                       # HALF_UP on the first rounding


def test_guarded_percent_and_kpis(spark):
    df = spark.createDataFrame([(True, "0.5"), (False, "0.5")], "z boolean, t string")
    got = [r[0] for r in df.select(guarded_percent(F.col("z"), F.col("t"))).collect()]
    assert math.isnan(got[0]) and got[1] == 50.0
    df = spark.createDataFrame([(4, 3), (0, 0), (0, 2), (2, 3)], "p int, d int")
    got = [r[0] for r in df.select(completion_pct("p", "d")).collect()]
    assert got[0] == 75.0 and math.isnan(got[1]) and got[2] == 0.0 and got[3] == 150.0
    df = spark.createDataFrame([(170.0, 158.0), (0.0, 0.0)], "m double, u double")
    assert [r[0] for r in df.select(efficiency_pct("m", "u")).collect()] == [51.83, None]


def test_cell_views(spark):
    rows = [("numeric", 2.5, None), ("blank", None, None), ("formula", 4.0, None),
            ("formula", None, "txt"), ("string", None, "s"), ("boolean", 1.0, None), (None, None, None)]
    df = spark.createDataFrame(rows, "ctype string, num double, str string")
    got = df.select(numeric_read().alias("v"), numeric_read_error().alias("e"),
                    string_read().alias("s")).collect()
    assert [r["v"] for r in got] == [2.5, 0.0, 4.0, None, None, None, None]
    assert [r["e"] for r in got] == [None, None, None, "not numeric: formula",
                                     "not numeric: string", "not numeric: boolean", "missing cell"]
    assert [r["s"] for r in got] == [None, "", None, "txt", "s", None, None]
