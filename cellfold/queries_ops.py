"""Per-operator registered queries and their oracles.

Each query runs one engine operator (or a named stage of a program) over a
derived grid; each oracle derives the same answer from the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellfold.functions.metrics import clamp_nonneg, round_half_up, text_percent
from cellfold.functions.text import arith_text_eval, blank_to_zero_int, formatted_text
from cellfold.operators.locate import (SHEET, cell_text_norm, column_window,
                                       find_header_anchor, find_label_any,
                                       find_label_first_col, find_labels_indexed, offset_lookup,
                                       pos_key, sheet_resolve)
from cellfold.operators.regions import (list_drop_index, merged_height_by_row,
                                        merged_regions_by_col, quarter_pivot,
                                        region_last_value, region_members,
                                        region_of_rows, region_ordered_list, stride_pairs)
from cellfold.plans import catalog
from cellfold.plans.efficiency import efficiency_anchors, equipment_efficiency
from cellfold.plans.form import OUTPUT_COLUMNS as FORM_COLUMNS
from cellfold.plans.form import form_anchors, form_record
from cellfold.plans.inspection import inspection_program
from cellfold.queries import (ORACLE_SQL, _G1_MON_SQL, _G1_SHEET, _G1_WB, _G2_AGG_SQL,
                              _MONTHS_SQL, _YEAR0,
                              _g2_pct_sql, _g3_program_sql, _g3_slots_sql, _rhu, register)
from cellfold.session import stored
from cellfold.sources.grids import (FORM_LABELS, LOCATION_HEADER, METERED_LABEL,
                                    UNPLANNED_LABEL)

_G1_SHEETS_SQL = ("SELECT DISTINCT l_suppkey AS suppkey, CAST(year(l_shipdate) AS INTEGER) AS yr "
                  "FROM lineitem")
_G3_SHEETS_SQL = ("SELECT DISTINCT l_suppkey AS suppkey, CAST(year(l_shipdate) AS INTEGER) AS yr "
                  "FROM lineitem JOIN part ON l_partkey = p_partkey")
_ROLES = {"unplanned": UNPLANNED_LABEL, "metered": METERED_LABEL}
_GUARDS = {"unplanned": "%"}


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows: list[tuple], names: list[str]) -> str:
    body = ", ".join("(" + ", ".join(_sql_str(v) if isinstance(v, str) else str(v) for v in r)
                     + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(names)}))"


def _year_sheets(corpus):
    return corpus.sheets.filter(F.col("sheet_idx") > 0).select(*SHEET)


# ---------------------------------------------------------------------------
# Sources: S-02, S-04/S-05/O-01
# ---------------------------------------------------------------------------

@register("sheet_catalog", f"""
WITH s AS ({_G1_SHEETS_SQL})
SELECT {_G1_WB} AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx, {_G1_SHEET} AS sheet,
       'platform ' || CAST(yr AS VARCHAR) AS sheet_key
FROM s
UNION ALL
SELECT DISTINCT {_G1_WB}, CAST(0 AS INTEGER), 'Summary', 'summary' FROM s
""")
def q_sheet_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.g1(spark, sf_dir).sheets


_CELLS_SCAN_SQL = f"""
WITH g1 AS ({_G1_SHEETS_SQL}),
a AS ({_G2_AGG_SQL}),
s AS ({_g3_slots_sql()}),
g3s AS (SELECT DISTINCT suppkey, yr FROM s),
g3t AS (SELECT suppkey, yr, count(DISTINCT ptype) AS n_types,
               count(DISTINCT ptype || '|' || brand) AS n_pairs,
               count(CASE WHEN n_open > 0 THEN 1 END) AS n_pnum,
               count(CASE WHEN n_open = 0 THEN 1 END) AS n_pstr,
               count(CASE WHEN returned = 1 THEN 1 END) AS n_cnum,
               count(CASE WHEN returned = 0 THEN 1 END) AS n_cstr
        FROM s GROUP BY 1, 2),
counts AS (
  SELECT {_G1_WB} AS workbook, yr - {_YEAR0} AS sheet_idx, 'string' AS ctype, 21 AS n FROM g1
  UNION ALL SELECT {_G1_WB}, yr - {_YEAR0}, 'numeric', 36 FROM g1
  UNION ALL SELECT DISTINCT {_G1_WB}, 0, 'string', 2 FROM g1
  UNION ALL SELECT DISTINCT {_G1_WB}, 0, 'numeric', 1 FROM g1
  UNION ALL SELECT 'customer-' || CAST(custkey AS VARCHAR), 1, 'string',
                   24 + CASE WHEN n_orders > 0 THEN 1 ELSE 0 END FROM a
  UNION ALL SELECT 'customer-' || CAST(custkey AS VARCHAR), 1, 'numeric',
                   2 + (p1 > 0)::INT + (p2 > 0)::INT + (p3 > 0)::INT + (p4 > 0)::INT
                     + (r1 > 0)::INT + (r2 > 0)::INT + (r3 > 0)::INT + (r4 > 0)::INT FROM a
  UNION ALL SELECT 'customer-' || CAST(custkey AS VARCHAR), 1, 'blank',
                   (r1 = 0)::INT + (r2 = 0)::INT + (r3 = 0)::INT + (r4 = 0)::INT FROM a
  UNION ALL SELECT 'customer-' || CAST(custkey AS VARCHAR), 0, 'string', 1 FROM a
  UNION ALL SELECT 'schedule-' || CAST(suppkey AS VARCHAR), yr - {_YEAR0}, 'string',
                   67 + 2 * n_types + 3 * n_pairs + n_pstr + n_cstr FROM g3t
  UNION ALL SELECT 'schedule-' || CAST(suppkey AS VARCHAR), yr - {_YEAR0}, 'numeric',
                   n_pnum + n_cnum FROM g3t)
SELECT workbook, CAST(sheet_idx AS INTEGER) AS sheet_idx, ctype, CAST(n AS BIGINT) AS n_cells
FROM counts WHERE n > 0
"""


@register("cells_scan", _CELLS_SCAN_SQL)
def q_cells_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = (catalog.g1(spark, sf_dir).union(catalog.g2(spark, sf_dir))
              .union(catalog.g3(spark, sf_dir)))
    return (corpus.cells.groupBy("workbook", "sheet_idx", "ctype")
            .agg(F.count(F.lit(1)).alias("n_cells")))


# ---------------------------------------------------------------------------
# Locate: P-06, P-01, P-02, P-03, P-05, P-04, P-07, P-08
# ---------------------------------------------------------------------------

#: The tabs asked for, one per year of the data (``y``), in odd case.
_TABS_SQL = ("SELECT CAST(y - lo AS INTEGER) AS tab_ord, CASE WHEN y % 2 = 1 THEN 'PLATFORM ' "
             "ELSE 'platform ' END || CAST(y AS VARCHAR) AS tab FROM (SELECT lo, "
             "unnest(range(lo, hi + 1 + {ahead})) AS y FROM (SELECT min(year(l_shipdate)) AS lo, "
             "max(year(l_shipdate)) AS hi FROM lineitem))")


@register("sheet_resolve", f"""
WITH s AS ({_G1_SHEETS_SQL}), w AS (SELECT DISTINCT suppkey FROM s),
y AS ({_TABS_SQL.format(ahead=1)}),
t AS (SELECT * FROM y
      UNION ALL SELECT max(tab_ord) + 1, ' ' || arg_min(tab, tab_ord) FROM y),
p AS (SELECT * FROM {_values([('issue',), ('first_sheet',)], ['policy'])})
SELECT p.policy, 'supplier-' || CAST(w.suppkey AS VARCHAR) AS workbook,
       CAST(t.tab_ord AS INTEGER) AS tab_ord, t.tab AS tab,
       CAST(CASE WHEN s.yr IS NOT NULL THEN s.yr - {_YEAR0}
                 WHEN p.policy = 'first_sheet' THEN 0 END AS INTEGER) AS sheet_idx,
       s.yr IS NOT NULL AS found
FROM w CROSS JOIN t CROSS JOIN p
LEFT JOIN s ON s.suppkey = w.suppkey AND lower(t.tab) = 'platform ' || CAST(s.yr AS VARCHAR)
""")
def q_sheet_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = catalog.g1(spark, sf_dir).sheets
    tabs = catalog.g1_tabs(spark, sf_dir, ahead=1)  # the year after the last has no sheet
    tabs.append(" " + tabs[0])  # a blank in the asked name is not trimmed
    return (sheet_resolve(sheets, tabs, "issue").withColumn("policy", F.lit("issue"))
            .unionByName(sheet_resolve(sheets, tabs, "first_sheet")
                         .withColumn("policy", F.lit("first_sheet"))))


_JTRIM_SQL = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


@register("find_label_first_col", f"""
WITH s AS ({_G1_SHEETS_SQL})
SELECT {_G1_WB} AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx, r.role,
       CAST(r.row AS INTEGER) AS row
FROM s CROSS JOIN {_values([('metered', 1), ('unplanned', 2)], ['role', 'row'])} AS r
""")
def q_find_label_first_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_label_first_col(catalog.g1(spark, sf_dir).cells, _ROLES, _GUARDS)


@register("find_label_any", f"""
WITH s AS ({_G3_SHEETS_SQL})
SELECT 'schedule-' || CAST(suppkey AS VARCHAR) AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       CAST(1 AS INTEGER) AS row, CAST(0 AS INTEGER) AS col
FROM s
""")
def q_find_label_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_label_any(catalog.g3(spark, sf_dir).cells, LOCATION_HEADER)


@register("find_labels_indexed", f"""
WITH s AS ({_G1_SHEETS_SQL})
SELECT {_G1_WB} AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx, r.role,
       CAST(r.row AS INTEGER) AS row, CAST(CASE WHEN r.role = 'jan' THEN 2 + suppkey % 3 ELSE 0 END AS INTEGER) AS col
FROM s CROSS JOIN {_values([('jan', 4), ('metered', 1), ('unplanned', 3)], ['role', 'row'])} AS r
""")
def q_find_labels_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last cell of three labels in every sheet: without guards these are the month name
    on the remarks row and the unplanned percentages."""
    return find_labels_indexed(catalog.g1(spark, sf_dir), {**_ROLES, "jan": "jan"})


@register("find_header_anchor", f"""
WITH s AS ({_G1_SHEETS_SQL})
SELECT {_G1_WB} AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       CAST(0 AS INTEGER) AS row, CAST(2 + suppkey % 3 AS INTEGER) AS col
FROM s
""")
def q_find_header_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_header_anchor(catalog.g1(spark, sf_dir).cells, "jan")


_FORM_LAYOUT = [("total", 1, 1), ("outdated", 2, 1), ("last_year", 3, 1), ("planned", 4, 4),
                ("reviewed", 8, 4), ("carried", 12, 4), ("pct", 16, 4), ("element", 20, 5)]
_FORM_LAYOUT_SQL = _values(_FORM_LAYOUT, ["field", "lrow", "height"])


@register("find_label_in_merge", f"""
SELECT 'customer-' || CAST(c_custkey AS VARCHAR) AS workbook, CAST(1 AS INTEGER) AS sheet_idx,
       f.field, CAST(f.lrow AS INTEGER) AS row,
       CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS col,
       CAST(f.height AS INTEGER) AS height
FROM customer CROSS JOIN {_FORM_LAYOUT_SQL} AS f
""")
def q_find_label_in_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g2(spark, sf_dir)
    a = form_anchors(corpus)
    return a.drop("pos")


@register("column_window_read", f"""
WITH s AS ({_G1_SHEETS_SQL}), mon AS ({_G1_MON_SQL}),
g AS (SELECT s.suppkey, s.yr, k.k FROM s CROSS JOIN range(0, 12) AS k(k))
SELECT {_G1_WB.replace('suppkey', 'g.suppkey')} AS workbook,
       CAST(g.yr - {_YEAR0} AS INTEGER) AS sheet_idx, r.role, CAST(g.k AS INTEGER) AS k,
       CAST(coalesce(CASE r.role WHEN 'metered' THEN mon.m ELSE mon.u END, 0) AS DOUBLE) AS value
FROM g CROSS JOIN {_values([('metered',), ('unplanned',)], ['role'])} AS r
LEFT JOIN mon ON mon.suppkey = g.suppkey AND mon.yr = g.yr AND mon.mo = g.k + 1
""")
def q_column_window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g1(spark, sf_dir)
    a = efficiency_anchors(corpus, _year_sheets(corpus))
    roles = F.array(F.struct(F.lit("metered").alias("role"), F.col("metered_row").alias("row")),
                    F.struct(F.lit("unplanned").alias("role"), F.col("unplanned_row").alias("row")))
    t = (a.select(*SHEET, F.col("hdr_col").alias("start"), F.explode(roles).alias("r"))
         .select(*SHEET, "start", "r.role", "r.row"))
    w = column_window(corpus.cells, t, 12, tags=["role"])
    return w.select("workbook", "sheet_idx", "role", F.col("k").cast("int").alias("k"), "value")


# ---------------------------------------------------------------------------
# Scalars: F-08/F-09, F-04/F-05, F-06/F-07, S-07/F-12/F-13, A-08/F-14
# ---------------------------------------------------------------------------

@register("clamp_round", f"""
SELECT src, id, x, {_rhu('CASE WHEN x < 0 THEN 0.0 ELSE x END')} AS value
FROM (SELECT 'supplier' AS src, s_suppkey AS id, s_acctbal / 7.0 AS x FROM supplier
      UNION ALL SELECT 'customer', c_custkey, c_acctbal / 7.0 FROM customer)
""")
def q_clamp_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.lit("supplier").alias("src"), F.col("s_suppkey").alias("id"),
        (F.col("s_acctbal") / 7.0).alias("x"))
    cus = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.lit("customer").alias("src"), F.col("c_custkey").alias("id"),
        (F.col("c_acctbal") / 7.0).alias("x"))
    return sup.unionByName(cus).withColumn("value", round_half_up(clamp_nonneg(F.col("x")), 2))


def _g2_field_values(spark, sf_dir):
    return form_record(catalog.g2(spark, sf_dir)).stages["values"]


@register("arith_text_eval", f"""
WITH a AS ({_G2_AGG_SQL}),
v AS (SELECT * FROM {_values([('plus', ' + '), ('minus', ' - '), ('times', ' * '),
                              ('bad_op', ' / ')], ['variant', 'op'])})
SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook, variant,
       CAST(nf AS VARCHAR) || op || CAST(no_ AS VARCHAR) AS text,
       CAST(CASE variant WHEN 'plus' THEN nf + no_ WHEN 'minus' THEN nf - no_
                         WHEN 'times' THEN nf * no_ END AS INTEGER) AS value
FROM a CROSS JOIN v
UNION ALL
SELECT 'customer-' || CAST(custkey AS VARCHAR), 'single', CAST(nf AS VARCHAR), CAST(nf AS INTEGER)
FROM a
""")
def q_arith_text_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _g2_field_values(spark, sf_dir).filter((F.col("field") == "total"))
    base = v.select("workbook", F.col("v_text").alias("t"))
    variants = F.array(
        F.struct(F.lit("plus").alias("variant"), F.col("t").alias("text")),
        F.struct(F.lit("minus").alias("variant"), F.replace("t", F.lit(" + "), F.lit(" - ")).alias("text")),
        F.struct(F.lit("times").alias("variant"), F.replace("t", F.lit(" + "), F.lit(" * ")).alias("text")),
        F.struct(F.lit("bad_op").alias("variant"), F.replace("t", F.lit(" + "), F.lit(" / ")).alias("text")),
        F.struct(F.lit("single").alias("variant"), F.split_part("t", F.lit(" "), F.lit(1)).alias("text")))
    x = base.select("workbook", F.explode(variants).alias("v")).select("workbook", "v.*")
    return x.withColumn("value", arith_text_eval(F.col("text")))


def _g2_quarter_text_sql(field: str, k: int) -> str:
    if field == "planned":
        return f"CASE WHEN p{k} > 0 THEN CAST(p{k} AS VARCHAR) ELSE '' END"
    if field == "reviewed":
        return f"CASE WHEN r{k} > 0 THEN CAST(r{k} AS VARCHAR) ELSE '' END"
    return f"CAST(c{k} AS VARCHAR)"


def _g2_quarter_rows_sql() -> str:
    parts = []
    for f, col in (("planned", "p"), ("reviewed", "r"), ("carried", "c")):
        for k in range(1, 5):
            parts.append(f"SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook, '{f}' AS field, "
                         f"{k - 1} AS i, {_g2_quarter_text_sql(f, k)} AS raw_text, "
                         f"CAST({col}{k} AS INTEGER) AS value FROM a")
    return "\nUNION ALL ".join(parts)


@register("blank_to_zero_int", f"""
WITH a AS ({_G2_AGG_SQL})
SELECT workbook, field, CAST(i AS INTEGER) AS i, raw_text, value FROM ({_g2_quarter_rows_sql()})
""")
def q_blank_to_zero_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _g2_field_values(spark, sf_dir).filter(F.col("field").isin("planned", "reviewed", "carried"))
    return v.select("workbook", "field", F.col("i").cast("int").alias("i"),
                    F.col("v_text").alias("raw_text"),
                    blank_to_zero_int(F.col("v_text")).alias("value"))


def _g2_ratio_sql(k: int) -> str:
    q4 = f"((r{k} * 10000) // p{k})"
    return (f"CASE WHEN p{k} > 0 THEN CAST({q4} // 10000 AS VARCHAR) || '.' || "
            f"lpad(CAST({q4} % 10000 AS VARCHAR), 4, '0') ELSE '0' END")


@register("text_percent_parse", f"""
WITH a AS ({_G2_AGG_SQL})
SELECT workbook, CAST(i AS INTEGER) AS i, text, pct FROM (
""" + "\nUNION ALL ".join(
    f"SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook, {k - 1} AS i, "
    f"{_g2_ratio_sql(k)} AS text, "
    f"CASE WHEN p{k} > 0 THEN CAST(((r{k} * 10000) // p{k} + 50) // 100 AS DOUBLE) ELSE 0.0 END AS pct "
    f"FROM a" for k in range(1, 5)) + ")")
def q_text_percent_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _g2_field_values(spark, sf_dir).filter(F.col("field") == "pct")
    return v.select("workbook", F.col("i").cast("int").alias("i"), F.col("v_str").alias("text"),
                    text_percent(F.col("v_str")).alias("pct"))


#: texts of several forms made of a row's key and balance (k, b)
_FRACTION_FORMS = [("plain", "concat(CAST(k AS STRING), '.5')"), ("signed", "concat('-0.', CAST(k AS STRING))"),
                   ("exponent", "concat(CAST(k % 7 AS STRING), 'e-1')"), ("point", "concat('.', CAST(k AS STRING))"),
                   ("percent", "concat(CAST(k AS STRING), '%')"), ("blank", "concat(' ', CAST(k AS STRING))"),
                   ("words", "concat('n/a ', CAST(k AS STRING))"), ("twice", "concat('1.', CAST(k AS STRING), '.2')"),
                   ("empty", "''")]


def _fraction_forms_sql() -> str:
    number = {"plain": "k + 0.5", "signed": "0", "exponent": "(k % 7) / 10.0",
              "point": "CAST('0.' || CAST(k AS VARCHAR) AS DECIMAL(38, 18))"}
    parts = []
    for form, expr in _FRACTION_FORMS:
        text = expr.replace("AS STRING", "AS VARCHAR")
        n = number.get(form)
        value = (f"CAST(round(round(CAST({n} AS DECIMAL(38, 18)), 2) * 100, 2) AS DOUBLE)" if n
                 else "CAST('NaN' AS DOUBLE)")
        parts.append(f"SELECT k, '{form}' AS form, {text} AS text, {value} AS pct FROM (SELECT c_custkey AS k FROM customer)")
    return "\nUNION ALL ".join(parts)


@register("text_percent_any_text", _fraction_forms_sql())
def q_text_percent_any_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-13: texts that are decimals in every accepted form, and texts that are none."""
    forms = F.expr("array(" + ", ".join(f"struct('{f}' AS form, {e} AS text)" for f, e in _FRACTION_FORMS) + ")")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"))
    return rows.select("k", F.inline(forms)).withColumn("pct", text_percent(F.col("text")))


@register("form_missing_labels", f"""
WITH a AS ({_G2_AGG_SQL}), m AS (SELECT * FROM {_values([('default',), ('compat',)], ['mode'])})
SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook, mode,
       CAST(CASE mode WHEN 'compat' THEN 2147483647 END AS INTEGER) AS Op_Procedures,
       CASE mode WHEN 'compat' THEN '' END AS Last_Updated_OP_Year,
       CAST(np AS INTEGER) AS Number_Of_outdatedOPs, CAST(p2 AS INTEGER) AS Planned_for_Review_Q2,
       CAST(CASE mode WHEN 'compat' THEN 0 END AS INTEGER) AS Carried_Forward_Procedure_Q3,
       CASE mode WHEN 'compat' THEN CAST('NaN' AS DOUBLE) END AS Perc_of_Procedure_Rvd_Vs__Plnd_Q4
FROM a CROSS JOIN m
""")
def q_form_missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-15/Q-06: labels that the forms do not have: NULL by default, sentinels in compat mode."""
    labels = FORM_LABELS | {f: f"no such label: {f}" for f in ("total", "last_year", "carried", "pct")}
    modes = [form_record(catalog.g2(spark, sf_dir), labels=labels, compat=compat).table
             .withColumn("mode", F.lit("compat" if compat else "default")) for compat in (False, True)]
    return modes[0].unionByName(modes[1]).select(
        "workbook", "mode", "Op_Procedures", "Last_Updated_OP_Year", "Number_Of_outdatedOPs", "Planned_for_Review_Q2",
        "Carried_Forward_Procedure_Q3", "Perc_of_Procedure_Rvd_Vs__Plnd_Q4")


@register("job_lines", """
SELECT kind, path, trim(lower(kind)) AS dispatch_key FROM (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN 'EMY' WHEN 1 THEN 'adequacy' WHEN 2 THEN 'Aims' ELSE '' END AS kind,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '/in/' || CAST(o_orderkey AS VARCHAR) || '.xlsx' END AS path
  FROM orders)
""")
def q_job_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-18: job lines, the first two tokens between single spaces; a line may lack the
    path, hold more than two tokens, or begin with a space (an empty kind)."""
    from cellfold.plans.dispatch import normalise_kind, parse_job_args
    k = F.col("o_orderkey")
    kind = F.when(k % 4 == 0, "EMY").when(k % 4 == 1, "adequacy").when(k % 4 == 2, "Aims").otherwise("")
    path = F.when(k % 5 != 0, F.concat(F.lit(" /in/"), k.cast("string"), F.lit(".xlsx"))).otherwise("")
    more = F.when((k % 7 == 0) & (k % 5 != 0), F.lit(" more words")).otherwise("")
    lines = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.concat(kind, path, more).alias("value"))
    return parse_job_args(lines).withColumn("dispatch_key", normalise_kind("kind"))


@register("review_pct_guarded", f"""
WITH a AS ({_G2_AGG_SQL})
SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook,
       (p1 + p2 + p3 + p4 = 0) AS all_planned_zero,
       {_g2_pct_sql(1)} AS Perc_of_Procedure_Rvd_Vs__Plnd_Q1,
       {_g2_pct_sql(2)} AS Perc_of_Procedure_Rvd_Vs__Plnd_Q2,
       {_g2_pct_sql(3)} AS Perc_of_Procedure_Rvd_Vs__Plnd_Q3,
       {_g2_pct_sql(4)} AS Perc_of_Procedure_Rvd_Vs__Plnd_Q4
FROM a
""")
def q_review_pct_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = form_record(catalog.g2(spark, sf_dir)).table
    zero = None
    for q in range(1, 5):
        c = F.col(f"Planned_for_Review_Q{q}") == 0
        zero = c if zero is None else zero & c
    return t.select("workbook", zero.alias("all_planned_zero"),
                    *[f"Perc_of_Procedure_Rvd_Vs__Plnd_Q{q}" for q in range(1, 5)])


@register("typed_projection", f"""
WITH a AS ({_G2_AGG_SQL})
SELECT CAST(1 AS INTEGER) AS Document_Id, CAST(2018 AS INTEGER) AS "Year",
       CAST(nf + no_ AS INTEGER) AS Op_Procedures,
       coalesce(CAST(ly AS VARCHAR), '') AS Last_Updated_OP_Year,
       CAST(np AS INTEGER) AS Number_Of_outdatedOPs,
       CAST(p1 AS INTEGER) AS Planned_for_Review_Q1, CAST(p2 AS INTEGER) AS Planned_for_Review_Q2,
       CAST(p3 AS INTEGER) AS Planned_for_Review_Q3, CAST(p4 AS INTEGER) AS Planned_for_Review_Q4,
       CAST(c1 AS INTEGER) AS Carried_Forward_Procedure_Q1,
       CAST(c2 AS INTEGER) AS Carried_Forward_Procedure_Q2,
       CAST(c3 AS INTEGER) AS Carried_Forward_Procedure_Q3,
       CAST(c4 AS INTEGER) AS Carried_Forward_Procedure_Q4,
       {_g2_pct_sql(1)} AS Perc_of_Procedure_Rvd_Vs__Plnd_Q1,
       {_g2_pct_sql(2)} AS Perc_of_Procedure_Rvd_Vs__Plnd_Q2,
       {_g2_pct_sql(3)} AS Perc_of_Procedure_Rvd_Vs__Plnd_Q3,
       {_g2_pct_sql(4)} AS Perc_of_Procedure_Rvd_Vs__Plnd_Q4
FROM a
""")
def q_typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return form_record(catalog.g2(spark, sf_dir)).table.select(*FORM_COLUMNS[1:])


# ---------------------------------------------------------------------------
# Regions over G2: A-05, J-04, A-03, A-04/F-17/P-17, F-16, A-07
# ---------------------------------------------------------------------------

@register("merged_height_by_row", f"""
SELECT 'customer-' || CAST(c_custkey AS VARCHAR) AS workbook, CAST(1 AS INTEGER) AS sheet_idx,
       CAST(h.row AS INTEGER) AS row, CAST(h.height AS INTEGER) AS height
FROM customer CROSS JOIN {_values([(0, 1), (1, 1), (2, 1), (3, 1), (4, 4), (8, 4), (12, 4),
                                    (16, 4), (20, 5)], ['row', 'height'])} AS h
""")
def q_merged_height_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_height_by_row(catalog.g2(spark, sf_dir).merges)


@register("region_members", f"""
SELECT 'customer-' || CAST(c_custkey AS VARCHAR) AS workbook, CAST(1 AS INTEGER) AS sheet_idx,
       f.field, CAST(f.lrow + o.o AS INTEGER) AS row, CAST(o.o AS INTEGER) AS offset
FROM customer CROSS JOIN {_FORM_LAYOUT_SQL} AS f CROSS JOIN range(0, 5) AS o(o)
WHERE o.o < f.height
""")
def q_region_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g2(spark, sf_dir)
    a = form_anchors(corpus)
    regions = a.select(*SHEET, "field", F.col("row").alias("first_row"),
                       (F.col("row") + F.col("height") - 1).alias("last_row"))
    m = region_members(regions, keep=["field"])
    return m.select(*SHEET, "field", "row", F.col("offset").cast("int").alias("offset"))


def _g2_block_texts_sql() -> str:
    """Per customer and field: the value texts of the block in row order."""
    rows = []
    for k in range(1, 5):
        rows += [("planned", k - 1, _g2_quarter_text_sql("planned", k)),
                 ("reviewed", k - 1, _g2_quarter_text_sql("reviewed", k)),
                 ("carried", k - 1, _g2_quarter_text_sql("carried", k)),
                 ("pct", k - 1, _g2_ratio_sql(k))]
    rows += [("total", 0, "CAST(nf AS VARCHAR) || ' + ' || CAST(no_ AS VARCHAR)"),
             ("outdated", 0, "CAST(np AS VARCHAR)"),
             ("last_year", 0, "coalesce(CAST(ly AS VARCHAR), '')"),
             ("element", 0, "'segment ' || c_mktsegment"),
             ("element", 1, "'orders ' || CAST(n_orders AS VARCHAR)"),
             ("element", 2, "'(spare)'"),
             ("element", 3, "'name ' || c_name"),
             ("element", 4, "'late ' || CAST(no_ AS VARCHAR)")]
    return "\nUNION ALL ".join(
        f"SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook, '{f}' AS field, "
        f"{i} AS i, {expr} AS v FROM a" for f, i, expr in rows)


@register("offset_lookup", f"""
WITH a AS ({_G2_AGG_SQL}), b AS ({_g2_block_texts_sql()})
SELECT workbook, field, v AS value_text FROM b WHERE i = 0
""")
def q_offset_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g2(spark, sf_dir)
    v = offset_lookup(corpus.cells, form_anchors(corpus), 0, 21, tags=["field"])
    return v.select("workbook", "field", formatted_text("text").alias("value_text"))


@register("region_last_value", f"""
WITH a AS ({_G2_AGG_SQL}), b AS ({_g2_block_texts_sql()})
SELECT workbook, field, arg_max(v, i) AS v FROM b GROUP BY workbook, field
""")
def q_region_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _g2_field_values(spark, sf_dir).withColumnRenamed("v_text", "v")
    return region_last_value(v, ["workbook", "field"], "v", "i")


@register("region_ordered_list", f"""
WITH a AS ({_G2_AGG_SQL}), b AS ({_g2_block_texts_sql()})
SELECT workbook, field, string_agg(v, '|' ORDER BY i) AS v, CAST(count(*) AS INTEGER) AS n
FROM b GROUP BY workbook, field
""")
def q_region_ordered_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _g2_field_values(spark, sf_dir).withColumnRenamed("v_text", "v")
    lists = region_ordered_list(v, ["workbook", "field"], "v", "i")
    return lists.select("workbook", "field", F.array_join("v", "|").alias("v"),
                        F.size("v").alias("n"))


@register("list_drop_index", f"""
WITH a AS ({_G2_AGG_SQL})
SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook,
       'segment ' || c_mktsegment || '|orders ' || CAST(n_orders AS VARCHAR) || '|name ' || c_name
         || '|late ' || CAST(no_ AS VARCHAR) AS elements
FROM a
""")
def q_list_drop_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = (_g2_field_values(spark, sf_dir).filter(F.col("field") == "element")
         .withColumnRenamed("v_text", "v"))
    lists = region_ordered_list(v, ["workbook"], "v", "i")
    return lists.select("workbook", F.array_join(list_drop_index("v", 2), "|").alias("elements"))


@register("quarter_pivot", f"""
WITH a AS ({_G2_AGG_SQL})
SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook, f.field,
       CAST(CASE f.field WHEN 'planned' THEN p1 WHEN 'reviewed' THEN r1 ELSE c1 END AS INTEGER) AS q1,
       CAST(CASE f.field WHEN 'planned' THEN p2 WHEN 'reviewed' THEN r2 ELSE c2 END AS INTEGER) AS q2,
       CAST(CASE f.field WHEN 'planned' THEN p3 WHEN 'reviewed' THEN r3 ELSE c3 END AS INTEGER) AS q3,
       CAST(CASE f.field WHEN 'planned' THEN p4 WHEN 'reviewed' THEN r4 ELSE c4 END AS INTEGER) AS q4,
       CAST(4 AS BIGINT) AS n_members
FROM a CROSS JOIN {_values([('planned',), ('reviewed',), ('carried',)], ['field'])} AS f
""")
def q_quarter_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _g2_field_values(spark, sf_dir).filter(F.col("field").isin("planned", "reviewed", "carried"))
    return quarter_pivot(v, ["workbook", "field"], "v_int", "i")


# ---------------------------------------------------------------------------
# Efficiency: J-01/J-02/P-12/F-10/A-09, W-01/Q-01, K-02, S-03/K-03/U-01
# ---------------------------------------------------------------------------

@register("efficiency_pct", f"""
WITH mon AS ({_G1_MON_SQL})
SELECT {_G1_WB} AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx, CAST(mo - 1 AS INTEGER) AS k,
       CAST(m AS DOUBLE) AS Metered_Value, CAST(u AS DOUBLE) AS Unplanned_Value,
       {_rhu('m / (m + u) * 100')} AS Result
FROM mon WHERE m + u <> 0
""")
def q_efficiency_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = equipment_efficiency(catalog.g1(spark, sf_dir), catalog.g1_tabs(spark, sf_dir)).stages["points"]
    return pts.filter(F.col("kept")).select(
        "workbook", "sheet_idx", F.col("k").cast("int").alias("k"),
        F.col("m").alias("Metered_Value"), F.col("u").alias("Unplanned_Value"),
        F.col("result").alias("Result"))


@register("efficiency_pct_compat", f"""
WITH mon AS ({_G1_MON_SQL}),
kept AS (SELECT *, row_number() OVER (PARTITION BY suppkey, yr ORDER BY mo) AS ord
         FROM mon WHERE m + u <> 0)
SELECT {_G1_WB} AS workbook, CAST(2018 AS INTEGER) AS "Year",
       {_G1_SHEET} AS Platform_Name, {_MONTHS_SQL}[ord] AS Month,
       CAST(u AS DOUBLE) AS Unplanned_Value, CAST(m AS DOUBLE) AS Metered_Value,
       {_rhu('m / (m + u) * 100')} AS Result
FROM kept
""")
def q_efficiency_pct_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equipment_efficiency(catalog.g1(spark, sf_dir), catalog.g1_tabs(spark, sf_dir), compat=True).table


_T01_SQL = f"""
WITH mon AS ({_G1_MON_SQL})
SELECT suppkey, {_G1_WB} AS workbook, CAST(2018 AS INTEGER) AS "Year",
       {_G1_SHEET} AS Platform_Name, {_MONTHS_SQL}[mo] AS Month,
       CAST(u AS DOUBLE) AS Unplanned_Value, CAST(m AS DOUBLE) AS Metered_Value,
       {_rhu('m / (m + u) * 100')} AS Result
FROM mon WHERE m + u <> 0
"""


def _g1_jobs(corpus) -> DataFrame:
    """Job kinds for G1 workbooks: every fifth supplier is a gas workbook."""
    wbs = corpus.sheets.select("workbook").distinct()
    key = F.split_part("workbook", F.lit("-"), F.lit(2)).cast("bigint")
    return wbs.select("workbook", F.when(F.pmod(key, F.lit(5)) == 0, F.lit("emy2"))
                      .otherwise(F.lit("emy")).alias("kind"))


@register("route_by_kind", f"""
SELECT workbook, "Year", Platform_Name, Month, Unplanned_Value, Metered_Value, Result,
       CASE WHEN suppkey % 5 = 0 THEN 'gas' ELSE 'oil' END AS product
FROM ({_T01_SQL})
""")
def q_route_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellfold.plans.dispatch import run_jobs
    corpus = catalog.g1(spark, sf_dir)
    tabs = catalog.g1_tabs(spark, sf_dir)
    res = run_jobs(_g1_jobs(corpus), corpus, {"emy": tabs, "emy2": tabs})
    return res.efficiency


@register("multi_sheet_union", f"""
SELECT workbook, Platform_Name, count(*) AS n_months, min(Result) AS min_result,
       max(Result) AS max_result
FROM ({_T01_SQL}) GROUP BY workbook, Platform_Name
""")
def q_multi_sheet_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = equipment_efficiency(catalog.g1(spark, sf_dir), catalog.g1_tabs(spark, sf_dir)).table
    return t.groupBy("workbook", "Platform_Name").agg(
        F.count(F.lit(1)).alias("n_months"), F.min("Result").alias("min_result"),
        F.max("Result").alias("max_result"))


# ---------------------------------------------------------------------------
# Inspection over G3: P-09/J-03, S-08/P-10/W-02, A-01/P-15/F-11, Q-02, A-06,
# J-07/O-02, P-11
# ---------------------------------------------------------------------------

_G3_PAIRS_SQL = f"""
    SELECT suppkey, yr, ptype, brand, brand AS descr,
           3 + 2 * (row_number() OVER (PARTITION BY suppkey, yr ORDER BY ptype, brand) - 1) AS prow,
           dense_rank() OVER (PARTITION BY suppkey, yr ORDER BY ptype) + 1 AS decl_idx,
           min_size, last_ship
    FROM (SELECT suppkey, yr, ptype, brand, min(min_size) AS min_size, max(last_ship) AS last_ship
          FROM s GROUP BY 1, 2, 3, 4)
"""


@register("stride_pairs", f"""
WITH s AS ({_g3_slots_sql()}), pr AS ({_G3_PAIRS_SQL})
SELECT 'schedule-' || CAST(suppkey AS VARCHAR) AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       CAST(decl_idx AS INTEGER) AS decl_idx, CAST(prow AS INTEGER) AS prow,
       CAST(prow + 1 AS INTEGER) AS crow
FROM pr
UNION ALL
SELECT DISTINCT 'schedule-' || CAST(suppkey AS VARCHAR), CAST(yr - {_YEAR0} AS INTEGER),
       CAST(1 AS INTEGER), CAST(1 AS INTEGER), CAST(2 AS INTEGER)
FROM s
""")
def q_stride_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g3(spark, sf_dir)
    r = merged_regions_by_col(corpus.merges, find_label_any(corpus.cells, LOCATION_HEADER))
    p = stride_pairs(r, keep=["decl_idx", "first_row", "last_row"])
    return p.select("workbook", "sheet_idx", "decl_idx", "prow", "crow")


@register("region_of_rows", f"""
WITH s AS ({_g3_slots_sql()}), pr AS ({_G3_PAIRS_SQL})
SELECT 'schedule-' || CAST(suppkey AS VARCHAR) AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       CAST(prow AS INTEGER) AS row, descr AS text, CAST(decl_idx AS INTEGER) AS decl_idx,
       CAST(prow - min(prow) OVER (PARTITION BY suppkey, yr, decl_idx) AS INTEGER) AS offset
FROM pr
UNION ALL
SELECT DISTINCT 'schedule-' || CAST(suppkey AS VARCHAR), CAST(yr - {_YEAR0} AS INTEGER),
       CAST(1 AS INTEGER), 'Description', CAST(1 AS INTEGER), CAST(0 AS INTEGER)
FROM s
""")
def q_region_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in the column right of the location column, with its location block."""
    corpus = catalog.g3(spark, sf_dir)
    loc = find_label_any(corpus.cells, LOCATION_HEADER)
    texts = (corpus.cells.filter(F.col("ctype") == "string").select(*SHEET, "row", "col", "text")
             .join(loc.select(*SHEET, (F.col("col") + 1).alias("col")), [*SHEET, "col"]).drop("col"))
    return (region_of_rows(texts, merged_regions_by_col(corpus.merges, loc))
            .select(*SHEET, "row", "text", "decl_idx", "offset"))


@register("merged_regions_by_col", f"""
WITH s AS ({_g3_slots_sql()}), pr AS ({_G3_PAIRS_SQL})
SELECT 'schedule-' || CAST(suppkey AS VARCHAR) AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       CAST(decl_idx AS INTEGER) AS decl_idx, CAST(min(prow) AS INTEGER) AS first_row,
       CAST(max(prow) + 1 AS INTEGER) AS last_row, CAST(0 AS INTEGER) AS first_col,
       CAST(decl_idx AS INTEGER) AS ordinal
FROM pr GROUP BY suppkey, yr, decl_idx
UNION ALL
SELECT DISTINCT 'schedule-' || CAST(suppkey AS VARCHAR), CAST(yr - {_YEAR0} AS INTEGER),
       CAST(1 AS INTEGER), CAST(1 AS INTEGER), CAST(2 AS INTEGER), CAST(0 AS INTEGER),
       CAST(1 AS INTEGER)
FROM s
""")
def q_merged_regions_by_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g3(spark, sf_dir)
    return merged_regions_by_col(corpus.merges, find_label_any(corpus.cells, LOCATION_HEADER),
                                 with_ordinal=True).withColumn("ordinal",
                                                               F.col("ordinal").cast("int"))


def _pct_sql(k):
    return (f"CASE WHEN p{k} = 0 THEN (CASE WHEN c{k} = 0 THEN CAST('NaN' AS DOUBLE) "
            f"ELSE 0.0 END) ELSE CAST(c{k} AS DOUBLE) / p{k} * 100 END")


@register("completion_pct", f"""
WITH s AS ({_g3_slots_sql()}), pr AS ({_G3_PAIRS_SQL}),
cnt AS (SELECT suppkey, yr, ptype, brand,
        {", ".join(f"count(CASE WHEN slot // 12 + 1 = {k} AND n_open > 0 THEN 1 END) AS p{k}, "
                   f"count(CASE WHEN slot // 12 + 1 = {k} AND returned = 1 THEN 1 END) AS c{k}"
                   for k in range(1, 5))}
        FROM s GROUP BY 1, 2, 3, 4)
SELECT 'schedule-' || CAST(pr.suppkey AS VARCHAR) AS workbook,
       CAST(pr.yr - {_YEAR0} AS INTEGER) AS sheet_idx, CAST(prow AS INTEGER) AS prow,
       {", ".join(f"{_pct_sql(k)} AS Quarter{k}" for k in range(1, 5))}
FROM pr JOIN cnt USING (suppkey, yr, ptype, brand)
UNION ALL
SELECT DISTINCT 'schedule-' || CAST(suppkey AS VARCHAR), CAST(yr - {_YEAR0} AS INTEGER),
       CAST(1 AS INTEGER), CAST('NaN' AS DOUBLE), CAST('NaN' AS DOUBLE), CAST('NaN' AS DOUBLE),
       CAST('NaN' AS DOUBLE)
FROM s
""")
def q_completion_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = inspection_program(catalog.g3(spark, sf_dir)).stages["pairs"]
    return body.select("workbook", "sheet_idx", F.col("prow").cast("int").alias("prow"),
                       "Quarter1", "Quarter2", "Quarter3", "Quarter4")


_COMPAT_QUARTER = ("CASE WHEN slot <= 13 THEN 1 WHEN slot <= 25 THEN 2 "
                   "WHEN slot <= 37 THEN 3 ELSE 4 END")


@register("completion_pct_compat", _g3_program_sql(_COMPAT_QUARTER))
def q_completion_pct_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g3(spark, sf_dir, start=47)
    return inspection_program(corpus, compat_quarters=True).table


@register("dedupe_last_by_key", f"""
WITH s AS ({_g3_slots_sql()}), pr AS ({_G3_PAIRS_SQL}),
d AS (SELECT suppkey, yr, decl_idx, substr(brand, 1, 7) AS descr, min(prow) AS first_prow,
             arg_max(min_size, prow) AS min_size, arg_max(last_ship, prow) AS last_ship
      FROM pr GROUP BY 1, 2, 3, 4)
SELECT 'schedule-' || CAST(suppkey AS VARCHAR) AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       CAST(decl_idx AS INTEGER) AS region_id, descr AS Description,
       CAST(first_prow AS INTEGER) AS first_prow, CAST(min_size AS VARCHAR) AS freq,
       strftime(last_ship, '%Y-%m-%d') AS last_insp
FROM d
UNION ALL
SELECT DISTINCT 'schedule-' || CAST(suppkey AS VARCHAR), CAST(yr - {_YEAR0} AS INTEGER),
       CAST(1 AS INTEGER), 'Description', CAST(1 AS INTEGER), 'Survey Frequency', 'Last Inspection'
FROM s
""")
def q_dedupe_last_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = inspection_program(catalog.g3(spark, sf_dir, repeat=True)).stages["deduped"]
    return d.select("workbook", "sheet_idx", F.col("region_id").cast("int").alias("region_id"),
                    "Description", F.col("first_prow").cast("int").alias("first_prow"),
                    "freq", "last_insp")


@register("location_flatten", f"""
WITH s AS ({_g3_slots_sql()}), pr AS ({_G3_PAIRS_SQL})
SELECT 'schedule-' || CAST(suppkey AS VARCHAR) AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       CAST(decl_idx AS INTEGER) AS region_ord, ptype AS Location,
       'PF-' || lower(ptype) AS Platform_Installation, CAST(prow AS INTEGER) AS prow,
       descr AS Description
FROM pr
UNION ALL
SELECT DISTINCT 'schedule-' || CAST(suppkey AS VARCHAR), CAST(yr - {_YEAR0} AS INTEGER),
       CAST(1 AS INTEGER), 'Location', 'Platform Installation', CAST(1 AS INTEGER), 'Description'
FROM s
""")
def q_location_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g3(spark, sf_dir)
    res = inspection_program(corpus)
    ords = merged_regions_by_col(corpus.merges, find_label_any(corpus.cells, LOCATION_HEADER),
                                 with_ordinal=True).select(
        *SHEET, F.col("decl_idx").alias("region_id"), F.col("ordinal").cast("int").alias("region_ord"))
    pairs = res.stages["pairs"].select(*SHEET, "region_id", "prow", "Description")
    return (pairs.join(res.stages["heads"], [*SHEET, "region_id"])
            .join(ords, [*SHEET, "region_id"])
            .select("workbook", "sheet_idx", "region_ord",
                    F.coalesce("loc_name", F.lit("")).alias("Location"),
                    F.coalesce("platform", F.lit("")).alias("Platform_Installation"),
                    F.col("prow").cast("int").alias("prow"), "Description"))


@register("exclude_header_rows", f"""
WITH s AS ({_g3_slots_sql()}),
g AS (SELECT suppkey, yr, count(DISTINCT ptype || '|' || brand) AS n FROM s GROUP BY 1, 2)
SELECT 'schedule-' || CAST(suppkey AS VARCHAR) AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       n + 1 AS n_before, n AS n_after
FROM g
""")
def q_exclude_header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellfold.plans.inspection import exclude_header_rows
    # both counts come from the same rows, made once: so the reads need not be stored
    u = stored(inspection_program(catalog.g3(spark, sf_dir), store_reads=False).stages["unfiltered"], "unfiltered")
    before = u.groupBy(*SHEET).agg(F.count(F.lit(1)).alias("n_before"))
    after = exclude_header_rows(u).groupBy(*SHEET).agg(F.count(F.lit(1)).alias("n_after"))
    return before.join(after, SHEET)


# ---------------------------------------------------------------------------
# S-01 xlsx round trip over G1
# ---------------------------------------------------------------------------

def _g1_cells_sql() -> str:
    mon = _MONTHS_SQL
    met = " " + METERED_LABEL
    text_rows = _values([(0, 1, 'Unit', 0), (1, 0, met, 1), (1, 1, 'bbl', 0),
                         (2, 0, UNPLANNED_LABEL, 0), (2, 1, 'bbl', 0),
                         (3, 0, UNPLANNED_LABEL.lower(), 0), (3, 1, '%', 0),
                         (4, 0, 'Remarks', 0)], ["row", "col", "txt", "tab"])
    return f"""
WITH s AS ({_G1_SHEETS_SQL}), mon AS ({_G1_MON_SQL}),
g AS (SELECT s.suppkey, s.yr, k.k, 2 + s.suppkey % 3 AS st FROM s CROSS JOIN range(0, 12) AS k(k)),
v AS (SELECT g.*, coalesce(mon.m, 0) AS m, coalesce(mon.u, 0) AS u FROM g
      LEFT JOIN mon ON mon.suppkey = g.suppkey AND mon.yr = g.yr AND mon.mo = g.k + 1),
c AS (
  SELECT suppkey, yr - {_YEAR0} AS sheet_idx, 0 AS row, st + k AS col, 'string' AS ctype,
         CAST(NULL AS DOUBLE) AS num, {mon}[k + 1] AS text FROM v
  UNION ALL SELECT suppkey, yr - {_YEAR0}, 1, st + k, 'numeric', m, CAST(CAST(m AS BIGINT) AS VARCHAR) FROM v
  UNION ALL SELECT suppkey, yr - {_YEAR0}, 2, st + k, 'numeric', u, CAST(CAST(u AS BIGINT) AS VARCHAR) FROM v
  UNION ALL SELECT suppkey, yr - {_YEAR0}, 3, st + k, 'numeric', 99.0, '99' FROM v
  UNION ALL SELECT s.suppkey, s.yr - {_YEAR0}, t.row, t.col, 'string', NULL,
                   CASE WHEN t.tab = 1 THEN t.txt || chr(9) ELSE t.txt END
            FROM s CROSS JOIN {text_rows} AS t
  UNION ALL SELECT suppkey, yr - {_YEAR0}, 4, 2 + suppkey % 3, 'string', NULL, 'JAN' FROM s
  UNION ALL SELECT DISTINCT suppkey, 0, 0, 0, 'string', NULL, 'Summary' FROM s
  UNION ALL SELECT DISTINCT suppkey, 0, 1, 0, 'string', NULL, 'Supplier' FROM s
  UNION ALL SELECT DISTINCT suppkey, 0, 1, 1, 'numeric', CAST(suppkey AS DOUBLE),
                   CAST(suppkey AS VARCHAR) FROM s)
SELECT {_G1_WB} AS workbook, CAST(sheet_idx AS INTEGER) AS sheet_idx, CAST(row AS INTEGER) AS row,
       CAST(col AS INTEGER) AS col, ctype, CAST(num AS DOUBLE) AS num,
       CASE WHEN ctype = 'string' THEN text END AS str, text,
       lower({_JTRIM_SQL.format(x='text')}) AS text_key
FROM c
"""


@register("cell_text_norm", f"""
SELECT workbook, sheet_idx, row, col, text, {_JTRIM_SQL.format(x='text')} AS trimmed, text_key
FROM ({_g1_cells_sql()})
""")
def q_cell_text_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_text_norm(catalog.g1(spark, sf_dir).cells)


@register("label_index", f"""
SELECT text_key, count(*) AS n_cells, count(DISTINCT workbook || '#' || sheet_idx) AS n_sheets,
       max(CAST(row AS BIGINT) * 16384 + col) AS last_pos
FROM ({_g1_cells_sql()}) WHERE regexp_matches(text_key, '[a-z]') GROUP BY text_key
""")
def q_label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of the label index of G1: its cells, its sheets, its last position."""
    return catalog.g1(spark, sf_dir).labels.groupBy("text_key").agg(
        F.count(F.lit(1)).alias("n_cells"), F.countDistinct("sid", "sid2").alias("n_sheets"),
        F.max(pos_key()).alias("last_pos"))


@register("xlsx_ingest", _g1_cells_sql())
def q_xlsx_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellfold.sources.xlsx import corpus_to_xlsx, decode, to_corpus
    files = corpus_to_xlsx(catalog.g1(spark, sf_dir))
    corpus, _errors = to_corpus(decode(files))
    return corpus.cells.drop("formula")


# ---------------------------------------------------------------------------
# T-04 issues, S-09/P-16 dispatch, K-01 sink, Q-03 carry-over
# ---------------------------------------------------------------------------

@register("issues", f"""
WITH s AS ({_G1_SHEETS_SQL}), mon AS ({_G1_MON_SQL}), w AS (SELECT DISTINCT suppkey FROM s),
v AS (SELECT s.suppkey, s.yr, k.k, coalesce(mon.m, 0) AS m, coalesce(mon.u, 0) AS u
      FROM s CROSS JOIN range(0, 12) AS k(k)
      LEFT JOIN mon ON mon.suppkey = s.suppkey AND mon.yr = s.yr AND mon.mo = k.k + 1),
e AS (SELECT suppkey, yr, {_G1_WB} AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
             max(m) FILTER (k = 0) AS m0, max(u) FILTER (k = 0) AS u0,
             max(m) FILTER (k = 11) AS m11, max(u) FILTER (k = 11) AS u11 FROM v GROUP BY 1, 2),
gone AS (SELECT workbook, sheet_idx, 'metered label not found' AS reason FROM e WHERE m11 = 0 AND u11 = 0
  UNION ALL SELECT workbook, sheet_idx, 'unplanned label not found' FROM e WHERE m0 = 0 AND u0 = 0
  UNION ALL SELECT workbook, sheet_idx, 'month header not found' FROM e WHERE m0 = 0 AND u0 <> 0),
whole AS (SELECT v.*, e.workbook, e.sheet_idx FROM v JOIN e USING (suppkey, yr)
          WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.workbook = e.workbook AND g.sheet_idx = e.sheet_idx)),
t AS ({_TABS_SQL.format(ahead=2)}),
a AS (SELECT *, 'customer-' || CAST(custkey AS VARCHAR) AS workbook FROM ({_G2_AGG_SQL})),
b AS (SELECT suppkey, yr, count(DISTINCT ptype || '|' || brand) AS n FROM ({_g3_slots_sql()}) GROUP BY 1, 2)
SELECT workbook, sheet_idx, 'equipment_efficiency' AS operator,
       'metered month ' || CAST(k AS VARCHAR) || ': missing cell' AS reason
FROM whole WHERE m = 0
UNION ALL
SELECT workbook, sheet_idx, 'equipment_efficiency',
       'unplanned month ' || CAST(k AS VARCHAR) || ': not numeric: string'
FROM whole WHERE u = 0
UNION ALL SELECT workbook, sheet_idx, 'equipment_efficiency', reason FROM gone
UNION ALL
SELECT 'supplier-' || CAST(w.suppkey AS VARCHAR), CAST(NULL AS INTEGER), 'equipment_efficiency',
       'tab not found: ' || t.tab
FROM w CROSS JOIN t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.suppkey = w.suppkey
                  AND 'platform ' || CAST(s.yr AS VARCHAR) = lower(t.tab))
UNION ALL SELECT workbook, CAST(NULL AS INTEGER), 'form_record', 'form sheet not found' FROM a
  WHERE n_orders % 10 = 0
UNION ALL SELECT workbook, 1, 'form_record', 'not an integer in outdated row 0: ' || chr(39) || 'none' || chr(39)
  FROM a WHERE n_orders % 10 > 0 AND np = 0
UNION ALL SELECT workbook, 1, 'form_record', 'quarter block shorter than 4 rows: carried' FROM a
  WHERE n_orders % 10 > 0 AND c4 = 0
UNION ALL SELECT workbook, 1, 'form_record', 'percent text not a decimal' FROM a
  WHERE n_orders % 10 > 0 AND (p1 > 0 AND r1 = 0 OR p2 > 0 AND r2 = 0 OR p3 > 0 AND r3 = 0 OR p4 > 0 AND r4 = 0)
UNION ALL SELECT 'schedule-' || CAST(suppkey AS VARCHAR), CAST(yr - {_YEAR0} AS INTEGER), 'inspection_program',
       CASE n % 5 WHEN 0 THEN 'location header not found' ELSE 'month header not found' END
FROM b WHERE n % 5 < 2
""")
def q_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellfold.sources.grids import g1_with_faults, g2_with_faults, g3_with_faults
    t01 = equipment_efficiency(g1_with_faults(catalog.g1(spark, sf_dir)),
                               catalog.g1_tabs(spark, sf_dir, ahead=2))
    t02 = form_record(g2_with_faults(catalog.g2(spark, sf_dir)))
    t03 = inspection_program(g3_with_faults(catalog.g3(spark, sf_dir)), store_reads=False)
    return t01.issues.unionByName(t02.issues).unionByName(t03.issues)


_FORM_NUMBERS = [c for c in FORM_COLUMNS if c not in ("workbook", "Document_Id", "Year")]


def _unpivot_sql(names: list[str]) -> str:
    values = ", ".join(f"TRY_CAST({n} AS DOUBLE)" for n in names)
    return f"unnest([{', '.join(map(_sql_str, names))}]) AS field, unnest([{values}]) AS value"


@register("job_dispatch", f"""
SELECT workbook, 'emy' AS kind, Platform_Name || '|' || Month AS item, 'Result' AS field,
       Result AS value
FROM ({_T01_SQL})
UNION ALL
SELECT workbook, 'adequacy', '', {_unpivot_sql(_FORM_NUMBERS)}
FROM ({ORACLE_SQL['form_record']})
UNION ALL
SELECT workbook, 'aims', sheet_idx || '|' || Location || '|' || Description,
       {_unpivot_sql([f'Quarter{k}' for k in range(1, 5)])}
FROM ({_g3_program_sql('slot // 12 + 1')})
""")
def q_job_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellfold.plans.dispatch import run_jobs
    # the jobs name the workbooks of each grid; their cells are stored once, in the one corpus
    g1, g2, g3 = (grid(spark, sf_dir) for grid in (catalog.derived_g1, catalog.derived_g2, catalog.derived_g3))
    corpus = catalog.everything(spark, sf_dir)

    def jobs_of(c, kind):
        return c.sheets.select("workbook").distinct().withColumn("kind", F.lit(kind))
    # raw kinds in odd case and with blanks: dispatch normalises them once
    jobs = stored(jobs_of(g1, " Emy ").unionByName(jobs_of(g2, "ADEQUACY")).unionByName(jobs_of(g3, "aims")), "jobs")
    tabs = catalog.g1_tabs(spark, sf_dir)
    res = run_jobs(jobs, corpus, {"emy": tabs, "emy2": tabs})

    def values(df, kind, item, names):
        pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.expr(f"try_cast({n} AS DOUBLE)").alias("value"))
                          for n in names])
        return df.select("workbook", F.lit(kind).alias("kind"), item.alias("item"),
                         F.inline(pairs))
    return (values(res.efficiency, "emy", F.concat_ws("|", "Platform_Name", "Month"), ["Result"])
            .unionByName(values(res.form, "adequacy", F.lit(""), _FORM_NUMBERS))
            .unionByName(values(res.inspection, "aims",
                                F.concat_ws("|", "sheet_idx", "Location", "Description"),
                                [f"Quarter{k}" for k in range(1, 5)])))


@register("orc_append_roundtrip", f"""
SELECT workbook, "Year", Platform_Name, Month, Unplanned_Value, Metered_Value, Result
FROM ({_T01_SQL})
UNION ALL
SELECT workbook, "Year", Platform_Name, Month, Unplanned_Value, Metered_Value, Result
FROM ({_T01_SQL})
""")
def q_orc_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid
    from cellfold.session import scratch_path
    from cellfold.sinks.orc import append_orc
    t = equipment_efficiency(catalog.g1(spark, sf_dir), catalog.g1_tabs(spark, sf_dir)).table
    target = scratch_path(spark, f"orc_append_{uuid.uuid4().hex}")
    append_orc(t, target)
    append_orc(t, target)  # a re-run appends again: the row count doubles
    return spark.read.orc(target)


def _carryover_sql() -> str:
    """Oracle of the Q-03 carry-over over the brand-block schedule grid.

    Regions of the location column are numbered per sheet (header block 1,
    then the brand blocks in row order); for each sheet, ordinals up to the
    largest count so far take the region of the latest sheet (this or an
    earlier one) that has that ordinal, and its rows are read on the CURRENT
    sheet: a pair row there gives its values, any other row reads empty.
    """
    counts = ", ".join(
        f"count(CASE WHEN slot // 12 + 1 = {k} AND n_open > 0 THEN 1 END) AS p{k}, "
        f"count(CASE WHEN slot // 12 + 1 = {k} AND returned = 1 THEN 1 END) AS c{k}"
        for k in range(1, 5))
    last = ", ".join(f"arg_max(p{k}, x) AS p{k}, arg_max(c{k}, x) AS c{k}" for k in range(1, 5))
    pct = ", ".join(f"{_pct_sql(k)} AS Quarter{k}" for k in range(1, 5))
    slots = _g3_slots_sql().replace("p_type AS ptype", "p_brand AS ptype").replace(
        "p_brand AS brand", "p_type AS brand")
    return f"""
WITH s AS ({slots}),
pr AS (SELECT suppkey, yr, ptype AS loc, brand AS item, min(min_size) AS min_size,
              max(last_ship) AS last_ship, {counts}
       FROM s GROUP BY 1, 2, 3, 4),
pr2 AS (SELECT *, 1 + 2 * dense_rank() OVER (PARTITION BY suppkey, yr ORDER BY loc, item) AS prow
        FROM pr),
blk AS (SELECT suppkey, yr, loc, min(prow) AS first_row, max(prow) + 1 AS last_row
        FROM pr2 GROUP BY 1, 2, 3),
own AS (SELECT DISTINCT suppkey, yr, 1 AS ord, 1 AS first_row, 2 AS last_row FROM pr2
        UNION ALL
        SELECT suppkey, yr, 1 + row_number() OVER (PARTITION BY suppkey, yr ORDER BY first_row),
               first_row, last_row FROM blk),
nreg AS (SELECT suppkey, yr, count(*) AS n FROM own GROUP BY 1, 2),
sh AS (SELECT suppkey, yr, max(n) OVER (PARTITION BY suppkey ORDER BY yr
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m
       FROM nreg),
g AS (SELECT suppkey, yr, unnest(range(1, m + 1)) AS ord FROM sh),
eff AS (SELECT g.suppkey, g.yr, g.ord, arg_max(own.first_row, own.yr) AS first_row,
               arg_max(own.last_row, own.yr) AS last_row
        FROM g JOIN own ON own.suppkey = g.suppkey AND own.ord = g.ord AND own.yr <= g.yr
        GROUP BY 1, 2, 3),
xs AS (SELECT suppkey, yr, ord, first_row, unnest(range(first_row, last_row + 1, 2)) AS x
       FROM eff),
r AS (SELECT xs.suppkey, xs.yr, xs.ord, xs.x,
             CASE WHEN xs.x = 1 THEN 'Description' ELSE coalesce(p.item, '') END AS descr,
             CASE WHEN xs.x = 1 THEN 'Survey Frequency'
                  ELSE coalesce(CAST(p.min_size AS VARCHAR), '') END AS freq,
             CASE WHEN xs.x = 1 THEN 'Last Inspection'
                  ELSE coalesce(strftime(p.last_ship, '%Y-%m-%d'), '') END AS last_insp,
             {", ".join(f"coalesce(p.p{k}, 0) AS p{k}, coalesce(p.c{k}, 0) AS c{k}" for k in range(1, 5))}
      FROM xs LEFT JOIN pr2 p ON p.suppkey = xs.suppkey AND p.yr = xs.yr AND p.prow = xs.x),
d AS (SELECT suppkey, yr, ord, descr, arg_max(freq, x) AS freq, arg_max(last_insp, x) AS last_insp,
             {last}
      FROM r GROUP BY 1, 2, 3, 4),
l AS (SELECT eff.suppkey, eff.yr, eff.ord,
             CASE WHEN eff.first_row = 1 THEN 'Location' ELSE coalesce(b.loc, '') END AS Location,
             CASE WHEN eff.first_row = 1 THEN 'Platform Installation'
                  ELSE coalesce('PF-' || lower(b.loc), '') END AS Platform_Installation
      FROM eff LEFT JOIN blk b ON b.suppkey = eff.suppkey AND b.yr = eff.yr
                              AND b.first_row = eff.first_row)
SELECT 'schedule-' || CAST(d.suppkey AS VARCHAR) AS workbook, CAST(d.yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       l.Location, d.descr AS Description, d.freq AS Survey_Frequency, l.Platform_Installation,
       d.last_insp AS Last_Inspection, {pct}
FROM d JOIN l ON l.suppkey = d.suppkey AND l.yr = d.yr AND l.ord = d.ord
WHERE l.Location <> 'Location'
"""


@register("region_carryover_compat", _carryover_sql())
def q_region_carryover_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-03 compat over the schedule grid with a block per brand: the number of
    blocks varies by sheet, so later sheets re-read regions left by earlier ones."""
    # the table alone, which reads the cells once whether or not the reads are stored
    return inspection_program(catalog.g3(spark, sf_dir, blocks="brand"),
                              compat_regions=True, store_reads=False).table
