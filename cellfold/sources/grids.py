"""Workbook grids derived with Spark from the relational test tables.

The test data has no workbooks, so each layout is built here from Parquet
into the bronze ``cells``/``merges``/``sheets`` schema; the operators then
run on it unchanged. Grid size grows with the scale factor (one workbook per
supplier or customer).

* G1 metric grid (monthly efficiency):   workbook per supplier, one sheet per ship year.
* G2 form grid (procedure-review form):  workbook per customer, one form sheet.
* G3 schedule grid (inspection program): workbook per supplier, one sheet per ship year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellfold.functions.text import label_key
from cellfold.session import spread, stored
from cellfold.sources.bronze import (Corpus, cell, explode_cells, finish_cells, lay_cells,
                                     SHEET_ROW, keyed, number_text_sql, sql_lit, string_cell,
                                     with_sheet_key)

# Month header texts of the metric grid, in calendar order.
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
              "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# The row labels of the monthly metric sheet.
METERED_LABEL = "Total Metered Production"
UNPLANNED_LABEL = "Total Actual Unplanned Deferment (UPD) - WORPE"

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _rows(n: int) -> Column:
    """The first n rows of a sheet."""
    return F.array(*[F.lit(r) for r in range(n)])


def g1_sheet_name(suppkey, year) -> F.Column:
    """'Platform <year>', with a trailing blank in every fourth workbook."""
    return F.concat(F.lit("Platform "), year.cast("string"),
                    F.when(F.pmod(suppkey, F.lit(4)) == 0, F.lit(" ")).otherwise(F.lit("")))


def ship_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """The calendar years from the first to the last ship date of the data."""
    y = F.year("l_shipdate")
    lo, hi = _table(spark, sf_dir, "lineitem").agg(F.min(y), F.max(y)).first()
    return [] if lo is None else list(range(lo, hi + 1))


def g1_tab(year: int) -> str:
    """Requested tab name of a year, in odd case (compared lower-cased)."""
    return f"PLATFORM {year}" if year % 2 else f"platform {year}"


def g1_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (supplier, ship year): metered (status F) and unplanned (status O)
    quantity per month, zero where the month has no line. One aggregation."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_linestatus")
    month = F.month("l_shipdate")
    aggs = []
    for k in range(1, 13):
        aggs.append(F.sum(F.when((month == k) & (F.col("l_linestatus") == "F"),
                                 F.col("l_quantity")).otherwise(0.0)).alias(f"m{k}"))
        aggs.append(F.sum(F.when((month == k) & (F.col("l_linestatus") == "O"),
                                 F.col("l_quantity")).otherwise(0.0)).alias(f"u{k}"))
    return (li.groupBy(F.col("l_suppkey").alias("suppkey"),
                       F.year("l_shipdate").alias("year"))
            .agg(*aggs))


def g1_metric_grid(spark: SparkSession, sf_dir: str) -> Corpus:
    """G1. Per sheet: header row 0 (col 0 empty, 'Jan'..'Dec' from a start
    column that varies by workbook), metered row 1, unplanned row 2, a decoy
    unplanned row 3 whose unit is '%', and a decoy 'JAN' in row 4."""
    # the monthly sums feed cells, sheets and merges: compute them once
    mon = stored(g1_monthly(spark, sf_dir), "monthly")
    # sheet 0 is a summary tab; the year tabs follow in year order
    first = (ship_years(spark, sf_dir) or [0])[0]
    base = mon.selectExpr("concat('supplier-', CAST(suppkey AS STRING)) AS workbook",
                          f"CAST(year - {first} + 1 AS INT) AS sheet_idx", "suppkey", "year",
                          "2 + CAST(pmod(suppkey, 3) AS INT) AS start",
                          *[f"m{k}" for k in range(1, 13)], *[f"u{k}" for k in range(1, 13)])
    met_label = " " + METERED_LABEL + "\t"
    structs = [string_cell(0, 1, "Unit")]
    structs += [string_cell(0, f"start + {k}", MONTH_ABBR[k]) for k in range(12)]
    structs += [string_cell(1, 0, met_label), string_cell(1, 1, "bbl"),
                string_cell(2, 0, UNPLANNED_LABEL), string_cell(2, 1, "bbl"),
                string_cell(3, 0, UNPLANNED_LABEL.lower()), string_cell(3, 1, "%"),
                string_cell(4, 0, "Remarks"), string_cell(4, "start", "JAN")]
    for k in range(12):
        m, u = f"m{k + 1}", f"u{k + 1}"
        structs.append(cell(1, f"start + {k}", "numeric", num=m, text=number_text_sql(m)))
        structs.append(cell(2, f"start + {k}", "numeric", num=u, text=number_text_sql(u)))
        structs.append(cell(3, f"start + {k}", "numeric", num="99.0", text="'99'"))
    year_cells = explode_cells(base, ["workbook", "sheet_idx"], structs)

    wbs = base.select("workbook", "suppkey").distinct().withColumn("sheet_idx", F.lit(0))
    summary = [string_cell(0, 0, "Summary"), string_cell(1, 0, "Supplier"),
               cell(1, 1, "numeric", num="suppkey", text="CAST(suppkey AS STRING)")]
    summary_cells = explode_cells(wbs, ["workbook", "sheet_idx"], summary)
    cells = finish_cells(year_cells.unionByName(summary_cells))

    def lay(n: int) -> DataFrame:
        return (lay_cells(base, _rows(5), structs, n).unionByName(lay_cells(wbs, _rows(2), summary, n)))

    sheets = with_sheet_key(
        base.select("workbook", "sheet_idx",
                    g1_sheet_name(F.col("suppkey"), F.col("year")).alias("sheet"))
        .unionByName(wbs.select("workbook", "sheet_idx", F.lit("Summary").alias("sheet"))))
    merges = wbs.selectExpr("workbook", "sheet_idx", "0 AS decl_idx", "0 AS first_row",
                            "0 AS last_row", "0 AS first_col", "3 AS last_col")
    return Corpus(sheets, cells, merges, n_cells=mon.count() * len(structs), lay=lay)


# ---------------------------------------------------------------------------
# G2 form grid
# ---------------------------------------------------------------------------

# The form sheet name and the eight form labels, as written on
# the form (matching is on trimmed lower case).
FORM_SHEET = "Form - Document_Q1 2018"
FORM_LABELS = {
    "total": "Total number of operational procedures",
    "outdated": "Number of outdated OPs",
    "last_year": "Last updated OP (year)",
    "planned": "Number planned for review",
    "reviewed": "Number of procedure reviewed",
    "carried": "No of carried forward procedure for review",
    "pct": "% of procedure reviewed vs number planned",
    "element": "Element",
}
FORM_VALUE_OFFSET = 21


def g2_customer_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer (all of them, also those without orders): orders per
    calendar quarter (planned), of those status F (reviewed) and status O
    (carried), and totals. One join, one aggregation."""
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    j = cust.join(orders, cust.c_custkey == orders.o_custkey, "left")
    q = F.quarter("o_orderdate")
    st = F.col("o_orderstatus")
    aggs = []
    for k in range(1, 5):
        aggs += [F.count(F.when(q == k, 1)).alias(f"planned{k}"),
                 F.count(F.when((q == k) & (st == "F"), 1)).alias(f"reviewed{k}"),
                 F.count(F.when((q == k) & (st == "O"), 1)).alias(f"carried{k}")]
    aggs += [F.count(F.when(st == "F", 1)).alias("n_f"),
             F.count(F.when(st == "O", 1)).alias("n_o"),
             F.count(F.when(st == "P", 1)).alias("n_p"),
             F.count("o_orderdate").alias("n_orders"),
             F.max(F.year("o_orderdate")).alias("last_year")]
    return j.groupBy("c_custkey", "c_name", "c_mktsegment").agg(*aggs)


def g2_ratio_text_sql(reviewed: str, planned: str) -> str:
    """reviewed/planned truncated to 4 decimals, as text ('0.3333'); '0' when
    nothing is planned. Integer arithmetic, so every engine writes the same."""
    q4 = f"CAST({reviewed} * 10000 / {planned} AS BIGINT)"
    return (f"CASE WHEN {planned} > 0 THEN concat(CAST(CAST({q4} / 10000 AS BIGINT) AS STRING), "
            f"'.', lpad(CAST(pmod({q4}, 10000) AS STRING), 4, '0')) ELSE '0' END")


def g2_form_grid(spark: SparkSession, sf_dir: str) -> Corpus:
    """G2. One workbook per customer: sheet 0 'Cover', sheet 1 the form.

    Labels sit in column 0 (column 1 for every third customer) on rows where
    a merged region starts; values are 21 columns to the right. Quarter
    blocks are 4-row merges. A later-declared 2-row merge also starts on the
    planned row (the first declared one fixes the height), and an unmerged
    decoy 'Number planned for review' row sits at the bottom.
    """
    # the per-customer figures feed cells, sheets and merges: compute them once
    agg = stored(g2_customer_quarters(spark, sf_dir), "quarters")
    base = agg.selectExpr(
        "concat('customer-', CAST(c_custkey AS STRING)) AS workbook", "1 AS sheet_idx",
        "CASE WHEN pmod(c_custkey, 3) = 0 THEN 1 ELSE 0 END AS lc",
        f"CASE WHEN pmod(c_custkey, 5) = 0 THEN {sql_lit(' ' + FORM_SHEET.lower())} "
        f"ELSE {sql_lit(FORM_SHEET)} END AS sheet", "*")
    L, V = "lc", f"lc + {FORM_VALUE_OFFSET}"

    def n_cell(r, c, v, when=None):
        return cell(r, c, "numeric", num=v, text=number_text_sql(v), when=when)

    def t_cell(r, c, v):
        return cell(r, c, "string", s=v, text=v)

    total = "concat(CAST(n_f AS STRING), ' + ', CAST(n_o AS STRING))"
    structs = [string_cell(0, L, "Procedure adequacy form"),
               string_cell(1, L, FORM_LABELS["total"]), t_cell(1, V, total),
               string_cell(2, L, FORM_LABELS["outdated"]), n_cell(2, V, "n_p"),
               string_cell(3, L, FORM_LABELS["last_year"]),
               cell(3, V, "string", s="CAST(last_year AS STRING)",
                    text="CAST(last_year AS STRING)", when="last_year IS NOT NULL"),
               string_cell(4, L, FORM_LABELS["planned"]),
               string_cell(8, L, FORM_LABELS["reviewed"]),
               string_cell(12, L, FORM_LABELS["carried"]),
               string_cell(16, L, FORM_LABELS["pct"]),
               string_cell(20, L, FORM_LABELS["element"]),
               string_cell(25, L, FORM_LABELS["planned"]), n_cell(25, V, "999.0")]
    for k in range(1, 5):
        p, r, c = f"planned{k}", f"reviewed{k}", f"carried{k}"
        # planned: numeric when > 0, no cell at all when 0 (reads as blank)
        structs.append(n_cell(3 + k, V, p, when=f"{p} > 0"))
        # reviewed: numeric when > 0, a styled blank cell when 0
        structs.append(n_cell(7 + k, V, r, when=f"{r} > 0"))
        structs.append(cell(7 + k, V, "blank", text="''", when=f"{r} = 0"))
        # carried: always text
        structs.append(t_cell(11 + k, V, f"CAST({c} AS STRING)"))
        structs.append(t_cell(15 + k, V, g2_ratio_text_sql(r, p)))
    elements = ["concat('segment ', c_mktsegment)",
                "concat('orders ', CAST(n_orders AS STRING))", "'(spare)'",
                "concat('name ', c_name)", "concat('late ', CAST(n_o AS STRING))"]
    for i, e in enumerate(elements):
        structs.append(t_cell(20 + i, V, e))
    form_cells = explode_cells(base, ["workbook", "sheet_idx"], structs)
    cover = base.selectExpr("workbook", "0 AS sheet_idx")
    on_cover = [string_cell(0, 0, "Cover")]
    cover_cells = explode_cells(cover, ["workbook", "sheet_idx"], on_cover)
    cells = finish_cells(form_cells.unionByName(cover_cells))

    def lay(n: int) -> DataFrame:
        return lay_cells(base, _rows(26), structs, n).unionByName(lay_cells(cover, _rows(1), on_cover, n))

    sheets = with_sheet_key(base.select("workbook", "sheet_idx", "sheet").unionByName(
        cover.withColumn("sheet", F.lit("Cover"))))

    def m(decl, r0, r1, c0, c1):
        return (f"named_struct('decl_idx', {decl}, 'first_row', {r0}, 'last_row', {r1}, "
                f"'first_col', CAST({c0} AS INT), 'last_col', CAST({c1} AS INT))")
    spans = [m(0, 0, 0, L, f"{L} + 20"), m(1, 1, 1, L, f"{L} + 20"), m(2, 2, 2, L, f"{L} + 20"),
             m(3, 3, 3, L, f"{L} + 20"), m(4, 4, 7, L, f"{L} + 20"),
             m(5, 4, 5, f"{V} + 1", f"{V} + 2"), m(6, 8, 11, L, f"{L} + 20"),
             m(7, 12, 15, L, f"{L} + 20"), m(8, 16, 19, L, f"{L} + 20"),
             m(9, 20, 24, L, f"{L} + 20")]
    merges = base.selectExpr("workbook", "sheet_idx", f"inline(array({', '.join(spans)}))")
    return Corpus(sheets, cells, merges, n_cells=agg.count() * len(structs), lay=lay)


# ---------------------------------------------------------------------------
# G3 schedule grid
# ---------------------------------------------------------------------------

# The location header and the first month header of the schedule.
LOCATION_HEADER = "Location"
MONTH_HEADER = "January 2018"
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]
WEEK_START = 49


def g3_slots(spark: SparkSession, sf_dir: str, blocks: str = "type") -> DataFrame:
    """Per (supplier, ship year, part type, brand, week slot 0..47): whether a
    line is shipped with status O (planned) and whether one is returned (R).

    ``blocks='type'``: a location block per part type with a pair per brand
    (``loc``=type, ``item``=brand); ``blocks='brand'``: a block per brand with
    a pair per part type. The brand variant has a varying number of blocks
    per sheet, so later sheets often have fewer regions than earlier ones."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_shipdate", "l_linestatus", "l_returnflag")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    j = li.join(part, li.l_partkey == part.p_partkey)
    slot = ((F.month("l_shipdate") - 1) * 4
            + F.least(F.lit(3), F.floor((F.dayofmonth("l_shipdate") - 1) / 8)).cast("int"))
    loc, item = ("p_type", "p_brand") if blocks == "type" else ("p_brand", "p_type")
    # dealt by sheet once, for the slots here and for the windows that place them; year and
    # slot are taken after the move
    lines = (j.select("l_suppkey", loc, item, "l_linestatus", "l_returnflag", "p_size", "l_shipdate")
             .repartition("l_suppkey", F.year("l_shipdate"))
             .select(F.col("l_suppkey").alias("suppkey"), F.year("l_shipdate").alias("year"),
                     F.col(loc).alias("ptype"), F.col(item).alias("brand"), slot.alias("slot"),
                     "l_linestatus", "l_returnflag", "p_size", "l_shipdate"))
    return (lines.groupBy("suppkey", "year", "ptype", "brand", "slot")
            .agg(F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("n_open"),
                 F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
                 F.min("p_size").alias("min_size"),
                 F.max("l_shipdate").alias("last_ship")))


def g3_schedule_grid(spark: SparkSession, sf_dir: str, start: int = WEEK_START,
                     blocks: str = "type", repeat: bool = False) -> Corpus:
    """G3. One workbook per supplier, one sheet per ship year.

    The description of a pair is its brand. ``repeat`` writes the brand's
    family instead ('Brand#1' for Brand#1 and Brand#10..19), so descriptions
    repeat inside a block; the last-wins key runs on that variant.

    Row 1 is the header ('Location' in column 0, month headers from column
    ``start`` every 4 columns), row 2 the week labels; the header rows form
    a 2-row merged region in column 0. Every part type is a location block:
    a merged region in column 0 with two rows per brand (planned row, then
    completed row). Week cells exist only where a line was shipped: planned
    is numeric when a line has status O, completed numeric when a line was
    returned, otherwise the cell holds '-'. A decoy 'Location' sits in row 0.

    One windowed pass over the slot table places every slot (pair row =
    number of (type, brand) in the sheet) and marks the first slot of each
    pair, block and sheet, which also emit the pair, block and header cells;
    the windows share the (supplier, year) partitioning, so one shuffle.
    """
    # columns 'ptype' / 'brand' hold the block key / pair key of the variant
    slots = g3_slots(spark, sf_dir, blocks)
    desc = "substring(brand, 1, 7)" if repeat else "brand"
    first = (ship_years(spark, sf_dir) or [0])[0]
    sheet_w = ["suppkey", "year"]
    by_pair = Window.partitionBy(*sheet_w, "ptype", "brand")
    by_block = Window.partitionBy(*sheet_w, "ptype")
    # one order of the slots of a sheet tells all places: where block or pair change, counted
    in_order = Window.partitionBy(*sheet_w).orderBy("ptype", "brand", "slot")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n_so_far = lambda first: F.sum(F.col(first).cast("int")).over(so_far).cast("int")
    changes = lambda c: ~F.col(c).eqNullSafe(F.col(f"{c}_before"))
    placed = (slots
              .withColumns({"sheet_first": F.row_number().over(in_order) == 1,
                            **{f"{c}_before": F.lag(c).over(in_order) for c in ("ptype", "brand")}})
              .withColumn("block_first", F.col("sheet_first") | changes("ptype"))
              .withColumn("pair_first", F.col("block_first") | changes("brand"))
              .drop("ptype_before", "brand_before")
              .withColumns({"n_pairs": n_so_far("pair_first"), "n_blocks": n_so_far("block_first")})
              .withColumns({"prow": 1 + 2 * F.col("n_pairs"), "decl_idx": 1 + F.col("n_blocks")})
              .drop("n_pairs", "n_blocks")
              .withColumns({"pair_size": F.min("min_size").over(by_pair), "pair_ship": F.max("last_ship").over(by_pair)})
              .withColumns({"block_first_row": F.min("prow").over(by_block),
                            "block_last_row": F.max("prow").over(by_block) + 1})
              .withColumn("workbook", F.concat(F.lit("schedule-"), F.col("suppkey").cast("string")))
              .withColumn("sheet_idx", (F.col("year") - F.lit(first - 1)).cast("int")))
    # cells, merges and sheets all read the placed slots: compute them once
    placed = stored(placed, "slots")

    def t_cell(r, c, v, when=None):
        return cell(r, c, "string", s=v, text=v, when=when)

    wc = f"{start} + slot"
    structs = [
        # week cells of every slot
        cell("prow", wc, "numeric", num="n_open", text="CAST(n_open AS STRING)",
             when="n_open > 0"),
        string_cell("prow", wc, "-", when="n_open = 0"),
        cell("prow + 1", wc, "numeric", num="1.0", text="'1'", when="returned > 0"),
        string_cell("prow + 1", wc, "-", when="returned = 0"),
        # pair cells, once per pair
        t_cell("prow", 1, desc, when="pair_first"),
        t_cell("prow", 2, "CAST(pair_size AS STRING)", when="pair_first"),
        t_cell("prow", 4, "date_format(pair_ship, 'yyyy-MM-dd')", when="pair_first"),
        # block cells, once per location block
        t_cell("block_first_row", 0, "ptype", when="block_first"),
        t_cell("block_first_row", 3, "concat('PF-', lower(ptype))", when="block_first"),
    ]
    hdr = [("0", 7, "Location"), ("0", 8, "Inspection programme"),
           ("1", 0, LOCATION_HEADER), ("1", 1, "Description"), ("1", 2, "Survey Frequency"),
           ("1", 3, "Platform Installation"), ("1", 4, "Last Inspection")]
    hdr += [("1", start + 4 * m, f"{MONTH_NAMES[m]} 2018") for m in range(12)]
    hdr += [("2", start + j, f"W{j % 4 + 1}") for j in range(48)]
    header = ("sheet_first", [string_cell(r, c, v) for r, c, v in hdr])
    cells = finish_cells(explode_cells(placed, ["workbook", "sheet_idx"], structs, header))

    def lay(n: int) -> DataFrame:
        # what only the first slot of a pair or block writes moves with that one
        slim = placed.withColumns({c: F.when(F.col(first_of), F.col(c)) for c, first_of in (
            ("brand", "pair_first"), ("pair_size", "pair_first"), ("pair_ship", "pair_first"),
            ("ptype", "block_first"), ("block_first_row", "block_first"))})
        rows = F.array(F.col("prow"), F.col("prow") + 1, F.when(F.col("block_first"), F.col("block_first_row")),
                       *[F.when(F.col("sheet_first"), F.lit(r)) for r in range(3)])
        return lay_cells(slim, rows, structs, n, header)

    sheets = with_sheet_key(placed.filter("sheet_first").selectExpr(
        "workbook", "sheet_idx", "concat('Y', CAST(year AS STRING)) AS sheet"))

    def m(decl, r0, r1, c0, c1, when):
        return (f"CASE WHEN {when} THEN named_struct('decl_idx', CAST({decl} AS INT), "
                f"'first_row', CAST({r0} AS INT), 'last_row', CAST({r1} AS INT), "
                f"'first_col', {c0}, 'last_col', {c1}) END")
    spans = [m(0, 0, 0, 7, 12, "sheet_first"), m(1, 1, 2, 0, 0, "sheet_first"),
             m("decl_idx", "block_first_row", "block_last_row", 0, 0, "block_first")]
    merges = placed.filter("sheet_first OR block_first").selectExpr(
        "workbook", "sheet_idx",
        f"inline(filter(array({', '.join(spans)}), x -> x IS NOT NULL))")
    # two week cells of a slot, three cells of a pair, two of a block, and the header
    n_cells = placed.agg(F.expr(f"coalesce(sum(2 + 3 * int(pair_first) + 2 * int(block_first) "
                                f"+ {len(hdr)} * int(sheet_first)), 0)")).first()[0]
    return Corpus(sheets, cells, merges, n_cells=n_cells, lay=lay)


# ---------------------------------------------------------------------------
# Planted faults (for the issues table)
# ---------------------------------------------------------------------------

def _without_labels(corpus: Corpus, cells: DataFrame, bad: DataFrame, labels: list[str]) -> DataFrame:
    """The corpus's ``cells`` without those of a sheet that read a label in ``bad`` (workbook,
    sheet_idx, text_key). Only cells that read one of ``labels`` are compared; those to go
    are dealt to the buckets, so the others stay where they lie."""
    found = cells.filter(F.col("text_key").isin([label_key(x) for x in labels]))
    gone = (found.select("workbook", "sheet_idx", "row", "col", "text_key")
            .join(bad, ["workbook", "sheet_idx", "text_key"], "left_semi"))
    at = [*SHEET_ROW, "col", "text_key"]
    return keyed(cells).join(corpus.dealt(gone).select(*at), at, "left_anti")


def _as_text(cells: DataFrame, which: Column, text: str) -> DataFrame:
    """The cells, those of ``which`` holding a text instead."""
    new = {"ctype": F.lit("string"), "str": F.lit(text), "text": F.lit(text), "text_key": F.lit(text),
           "num": F.lit(None).cast("double")}
    return cells.withColumns({c: F.when(which, v).otherwise(F.col(c)) for c, v in new.items()})


def g1_with_faults(corpus: Corpus) -> Corpus:
    """G1 with faults planted where the data is empty: a month with no metered
    quantity has NO cell (missing cell), a month with no unplanned quantity
    holds the text 'n/a' (not numeric). A sheet without any quantity in its
    last month has no metered label; without any in its first month, no
    unplanned label; with only unplanned quantity there, no month header."""
    c, r = corpus.cells, F.col("row")
    month_cell = (F.col("sheet_idx") > 0) & (F.col("ctype") == "numeric")
    of = lambda pick, row: pick(F.when(r == row, F.col("num")), F.when(r == row, F.col("col")))
    ends = (c.filter(month_cell & r.isin(1, 2)).groupBy("workbook", "sheet_idx")
            .agg(of(F.min_by, 1).alias("m0"), of(F.min_by, 2).alias("u0"),
                 of(F.max_by, 1).alias("m11"), of(F.max_by, 2).alias("u11")))
    header = MONTH_ABBR[0]
    gone = F.array(*[F.when(F.expr(cond), F.lit(label_key(label))) for cond, label in (
        ("m11 = 0 and u11 = 0", METERED_LABEL), ("m0 = 0 and u0 = 0", UNPLANNED_LABEL),
        ("m0 = 0 and u0 <> 0", header))])
    bad = (ends.select("workbook", "sheet_idx", F.explode(gone).alias("text_key"))
           .filter("text_key is not null"))
    empty = month_cell & (F.col("num") == 0)
    c = _as_text(c.filter(~(empty & (r == 1))), empty & (r == 2), "n/a")
    return Corpus(corpus.sheets, _without_labels(corpus, c, bad, [METERED_LABEL, UNPLANNED_LABEL, header]),
                  corpus.merges, buckets=corpus.buckets)


def g2_with_faults(corpus: Corpus) -> Corpus:
    """G2 where a customer whose number of orders ends in 0 has no form sheet (only
    the cover). A count of no outdated
    procedures is written 'none' (not an integer), a review share of nothing
    reviewed 'n/a' (not a decimal), and the carried block of a customer with
    nothing carried in the last quarter is one row short."""
    on_form = F.col("sheet_idx") == 1
    drop = (corpus.cells.filter(on_form & (F.col("row") == 21) & F.col("text").rlike("^orders [0-9]*0$"))
            .select("workbook", "sheet_idx").distinct())
    keep = lambda df: spread(df.join(drop, ["workbook", "sheet_idx"], "left_anti"))
    short = (corpus.cells.filter(on_form & (F.col("row") == 15) & (F.col("text") == "0"))
             .select("workbook", "sheet_idx", F.lit(12).alias("first_row"), F.lit(1).alias("short")).distinct())
    merges = (corpus.merges.join(short, ["workbook", "sheet_idx", "first_row"], "left")
              .withColumn("last_row", F.col("last_row") - F.coalesce("short", F.lit(0))).drop("short"))
    none = on_form & (F.col("row") == 2) & (F.col("ctype") == "numeric") & (F.col("num") == 0)
    c = _as_text(corpus.cells, none, "none")
    c = _as_text(c, on_form & F.col("row").between(16, 19) & (F.col("text") == "0.0000"), "n/a")
    return Corpus(keep(corpus.sheets), c, keep(merges), buckets=corpus.buckets)


def g3_with_faults(corpus: Corpus) -> Corpus:
    """G3 where a sheet with a multiple of five row pairs has no location header,
    and one with one pair more has no month header."""
    blocks = corpus.merges.filter("decl_idx >= 2").groupBy("workbook", "sheet_idx").agg(
        F.sum(F.expr("(last_row - first_row + 1) div 2")).alias("n"))
    gone = F.when(F.col("n") % 5 == 0, label_key(LOCATION_HEADER)).when(F.col("n") % 5 == 1, label_key(MONTH_HEADER))
    bad = blocks.select("workbook", "sheet_idx", gone.alias("text_key")).filter("text_key is not null")
    return Corpus(corpus.sheets, _without_labels(corpus, corpus.cells, bad, [LOCATION_HEADER, MONTH_HEADER]),
                  corpus.merges, corpus.rows, buckets=corpus.buckets)
