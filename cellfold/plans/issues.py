"""T-04 issues: every input condition that would abort the source job
becomes a quarantine row instead of a failure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISSUES_SCHEMA = T.StructType([
    T.StructField("workbook", T.StringType()),
    T.StructField("sheet_idx", T.IntegerType()),
    T.StructField("operator", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def issue_rows(df: DataFrame, operator: str, reason: Column | str,
               workbook="workbook", sheet_idx="sheet_idx") -> DataFrame:
    """Project ``df`` (already filtered to the bad rows) into the issues shape."""
    r = F.lit(reason) if isinstance(reason, str) else reason
    wb = F.col(workbook) if isinstance(workbook, str) else workbook
    si = F.col(sheet_idx) if isinstance(sheet_idx, str) else sheet_idx
    return df.select(wb.cast("string").alias("workbook"), si.cast("int").alias("sheet_idx"),
                     F.lit(operator).alias("operator"), r.cast("string").alias("reason"))


def each_reason(df: DataFrame, operator: str, reasons: list[Column]) -> DataFrame:
    """One issue row for every reason of a row that is not NULL, in one pass over ``df``."""
    found = df.select("workbook", "sheet_idx", F.explode(F.array(*reasons)).alias("reason"))
    return issue_rows(found.filter(F.col("reason").isNotNull()), operator, F.col("reason"))


def union_issues(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
