"""Merged-region operators (S-08, J-03..J-05, A-03..A-07, W-02, P-09, P-10).

A merged region is a rectangle ``first_row..last_row x first_col..last_col``
declared in order ``decl_idx``. Region-to-row membership (an interval join)
is turned into an equi-join by generating the member rows of each region
(``sequence(first_row, last_row)``): the work is proportional to the rows
the region covers, and the join key ``(workbook, sheet_idx, row)`` spreads a
large sheet over many tasks. Where the rows are given (``region_of_rows``), the
region is cut into power-of-two segments instead (``cellfold.operators.intervals``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellfold.operators.intervals import containing
from cellfold.operators.locate import SHEET


def merged_height_by_row(merges: DataFrame) -> DataFrame:
    """A-05: per start row, the height of the first *declared* region that
    starts there, whatever its column. Output: workbook, sheet_idx, row, height."""
    h = F.col("last_row") - F.col("first_row") + 1
    return (merges.groupBy(*SHEET, F.col("first_row").alias("row"))
            .agg(F.min_by(h, F.col("decl_idx")).alias("height")))


def merged_regions_by_col(merges: DataFrame, anchors: DataFrame,
                          with_ordinal: bool = False) -> DataFrame:
    """P-10: regions whose first column is the anchor column of their sheet.

    ``anchors``: workbook, sheet_idx, col. With ``with_ordinal`` the regions
    are numbered 1.. in declaration order within the sheet (W-02).
    Output: workbook, sheet_idx, decl_idx, first_row, last_row, first_col[, ordinal].
    """
    a = anchors.select(*SHEET, F.col("col").alias("first_col"))
    r = merges.join(a, [*SHEET, "first_col"]).select(
        *SHEET, "decl_idx", "first_row", "last_row", "first_col")
    if with_ordinal:
        w = Window.partitionBy(*SHEET).orderBy("decl_idx")
        r = r.withColumn("ordinal", F.row_number().over(w))
    return r


def region_members(regions: DataFrame, step: int = 1, keep: list[str] | None = None) -> DataFrame:
    """J-04 / P-09: one row per member row of each region (every ``step``-th
    row from the first). Adds ``row`` and 0-based ``offset`` (member index)."""
    keep = keep or [c for c in regions.columns if c not in SHEET]
    return (regions.select(*SHEET, *keep,
                           F.posexplode(F.sequence(F.col("first_row"), F.col("last_row"),
                                                   F.lit(step))).alias("offset", "row")))


def region_of_rows(rows: DataFrame, regions: DataFrame, row: str = "row") -> DataFrame:
    """J-04 for given rows: each with every region of its sheet that spans it, and the
    0-based ``offset`` in it. The regions' rows are not written out: a region of n rows
    becomes about 2 log n segments."""
    return (containing(rows, regions, SHEET, row)
            .withColumn("offset", (F.col(row) - F.col("first_row")).cast("int")))


def region_runs(regions: DataFrame, sheets: DataFrame) -> DataFrame:
    """Q-03: from which sheet to which a region of an ordinal is the latest one of its
    workbook (``first_sheet`` .. ``last_sheet``), one row per change.

    ``regions``: workbook, sheet_idx, ordinal, first_row, last_row; ``sheets``: workbook,
    sheet_idx. A region that the next sheet repeats goes on; one without a successor
    holds to the workbook's last sheet.
    """
    place = F.struct("first_row", "last_row")
    w = Window.partitionBy("workbook", "ordinal").orderBy("sheet_idx")
    changes = (regions.select(*SHEET, "ordinal", "first_row", "last_row")
               .withColumn("before", F.lag(place).over(w))
               .filter(~F.col("before").eqNullSafe(place)).drop("before")
               .withColumn("next", F.lead("sheet_idx").over(w)))
    ends = sheets.groupBy("workbook").agg(F.max("sheet_idx").alias("end"))
    return changes.join(ends, "workbook").select(
        "workbook", "ordinal", "first_row", "last_row", F.col("sheet_idx").alias("first_sheet"),
        F.coalesce(F.col("next") - 1, F.col("end")).alias("last_sheet"))


def stride_pairs(regions: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """J-03: rows first, first+2, ... <= last are 'planned' rows; the row
    under each is its 'completed' row (it may fall past the region end).
    Output: regions' columns + prow (pair row) and crow (completed row)."""
    m = region_members(regions, step=2, keep=keep)
    return m.withColumnRenamed("row", "prow").withColumn("crow", F.col("prow") + 1)


def region_last_value(values: DataFrame, keys: list[str], value: str = "v",
                      order: str = "row") -> DataFrame:
    """A-03: the value on the bottom row of each group."""
    return values.groupBy(*keys).agg(F.max_by(F.col(value), F.col(order)).alias(value))


def region_ordered_list(values: DataFrame, keys: list[str], value: str = "v",
                        order: str = "row") -> DataFrame:
    """A-04: the values of each region as an array in row order.

    The list is bounded by the region's height (at most the sheet's rows);
    ``collect_list`` of (order, value) structs sorted afterwards keeps it
    independent of shuffle order.
    """
    return (values.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                      F.col(value).alias("v")))).alias("_l"))
            .select(*keys, F.transform("_l", lambda x: x["v"]).alias(value)))


def list_drop_index(arr, i: int) -> Column:
    """F-16: drop the element at 0-based index ``i`` (no-op when shorter)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.filter(a, lambda x, j: j != i)


def quarter_pivot(values: DataFrame, keys: list[str], value: str = "v",
                  offset: str = "offset", n: int = 4, prefix: str = "q") -> DataFrame:
    """A-07: member offsets 0..n-1 of each region become columns q1..qn;
    extra members are ignored, missing ones are NULL (``n_members`` tells)."""
    aggs = [F.max(F.when(F.col(offset) == k, F.col(value))).alias(f"{prefix}{k + 1}")
            for k in range(n)]
    return values.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("n_members"))


def dedupe_last_by_key(df: DataFrame, keys: list[str], order: str,
                       fields: list[str]) -> DataFrame:
    """A-06: per key, the fields of the *last* row (by ``order``) and the
    position of the *first* one (insertion-ordered map semantics).

    An aggregation, not a window: partial aggregation runs map-side, so one
    key repeated very many times does not pile up in one task.
    """
    last = F.max(F.struct(F.col(order).alias("_o"), *[F.col(f) for f in fields]))
    return (df.groupBy(*keys)
            .agg(last.alias("_last"), F.min(order).alias("first_" + order))
            .select(*keys, "first_" + order, *[F.col("_last")[f].alias(f) for f in fields]))
