"""Registered queries (one per operator key) and their DuckDB oracle SQL.

Each query: (spark, sf_dir) -> DataFrame, computed by the engine's general
operators over a grid derived from the sf tables. Each oracle: ANSI SQL over
the base tables (views ``lineitem``, ``orders``, ...), no shared code.

Rounding in the oracle: Spark's round(double) is HALF_UP on the shortest
decimal text of the double, so the oracle rounds
``CAST(CAST(x AS VARCHAR) AS DECIMAL(38,18))``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellfold.plans import catalog
from cellfold.plans.efficiency import equipment_efficiency
from cellfold.plans.form import form_record
from cellfold.plans.inspection import inspection_program

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(key: str, sql: str | None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql.strip()
        return fn
    return deco


def _rhu(x: str) -> str:
    """Oracle HALF_UP rounding to 2 places of a DOUBLE expression."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


# Month header texts as an SQL list literal (1-based in DuckDB).
_MONTHS_SQL = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"

# G1 monthly sums, shared by the efficiency oracles.
_G1_MON_SQL = """
    SELECT l_suppkey AS suppkey, CAST(year(l_shipdate) AS INTEGER) AS yr,
           CAST(month(l_shipdate) AS INTEGER) AS mo,
           sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS m,
           sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS u
    FROM lineitem GROUP BY 1, 2, 3
"""

#: The sheet before the first ship year's (scalar).
_YEAR0 = "(SELECT min(year(l_shipdate)) - 1 FROM lineitem)"
_G1_WB = "'supplier-' || CAST(suppkey AS VARCHAR)"
_G1_SHEET = ("'Platform ' || CAST(yr AS VARCHAR) || "
             "CASE WHEN suppkey % 4 = 0 THEN ' ' ELSE '' END")


# ---------------------------------------------------------------------------
# T-01 flagship
# ---------------------------------------------------------------------------

@register("equipment_efficiency_table", f"""
WITH mon AS ({_G1_MON_SQL})
SELECT {_G1_WB} AS workbook, CAST(2018 AS INTEGER) AS "Year",
       {_G1_SHEET} AS Platform_Name,
       {_MONTHS_SQL}[mo] AS Month,
       CAST(u AS DOUBLE) AS Unplanned_Value, CAST(m AS DOUBLE) AS Metered_Value,
       {_rhu('m / (m + u) * 100')} AS Result
FROM mon WHERE m + u <> 0
""")
def q_equipment_efficiency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = catalog.g1(spark, sf_dir)
    return equipment_efficiency(corpus, catalog.g1_tabs(spark, sf_dir)).table


# ---------------------------------------------------------------------------
# T-02 form record over G2
# ---------------------------------------------------------------------------

_G2_AGG_SQL = """
    SELECT c.c_custkey AS custkey, c.c_name AS c_name, c.c_mktsegment AS c_mktsegment,
      count(CASE WHEN quarter(o_orderdate) = 1 THEN 1 END) AS p1,
      count(CASE WHEN quarter(o_orderdate) = 2 THEN 1 END) AS p2,
      count(CASE WHEN quarter(o_orderdate) = 3 THEN 1 END) AS p3,
      count(CASE WHEN quarter(o_orderdate) = 4 THEN 1 END) AS p4,
      count(CASE WHEN quarter(o_orderdate) = 1 AND o_orderstatus = 'F' THEN 1 END) AS r1,
      count(CASE WHEN quarter(o_orderdate) = 2 AND o_orderstatus = 'F' THEN 1 END) AS r2,
      count(CASE WHEN quarter(o_orderdate) = 3 AND o_orderstatus = 'F' THEN 1 END) AS r3,
      count(CASE WHEN quarter(o_orderdate) = 4 AND o_orderstatus = 'F' THEN 1 END) AS r4,
      count(CASE WHEN quarter(o_orderdate) = 1 AND o_orderstatus = 'O' THEN 1 END) AS c1,
      count(CASE WHEN quarter(o_orderdate) = 2 AND o_orderstatus = 'O' THEN 1 END) AS c2,
      count(CASE WHEN quarter(o_orderdate) = 3 AND o_orderstatus = 'O' THEN 1 END) AS c3,
      count(CASE WHEN quarter(o_orderdate) = 4 AND o_orderstatus = 'O' THEN 1 END) AS c4,
      count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS nf,
      count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS no_,
      count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS np,
      count(o_orderdate) AS n_orders,
      max(year(o_orderdate)) AS ly
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    GROUP BY 1, 2, 3
"""


def _g2_pct_sql(k: int) -> str:
    return (f"CASE WHEN p1 + p2 + p3 + p4 = 0 THEN CAST('NaN' AS DOUBLE) "
            f"WHEN p{k} = 0 THEN 0.0 "
            f"ELSE CAST(((r{k} * 10000) // p{k} + 50) // 100 AS DOUBLE) END")


@register("form_record", f"""
WITH a AS ({_G2_AGG_SQL})
SELECT 'customer-' || CAST(custkey AS VARCHAR) AS workbook,
       CAST(1 AS INTEGER) AS Document_Id, CAST(2018 AS INTEGER) AS "Year",
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
def q_form_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return form_record(catalog.g2(spark, sf_dir)).table


# ---------------------------------------------------------------------------
# T-03 inspection program over G3
# ---------------------------------------------------------------------------

def _g3_slots_sql(start_expr: str = "") -> str:
    return """
    SELECT l_suppkey AS suppkey, CAST(year(l_shipdate) AS INTEGER) AS yr, p_type AS ptype,
           p_brand AS brand,
           CAST((month(l_shipdate) - 1) * 4 + least(3, (day(l_shipdate) - 1) // 8) AS INTEGER) AS slot,
           count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS n_open,
           max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned,
           min(p_size) AS min_size, max(l_shipdate) AS last_ship
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2, 3, 4, 5
"""


def _g3_program_sql(qexpr: str) -> str:
    """Oracle of the inspection program over G3; ``qexpr`` maps ``slot`` to
    its quarter (NULL outside the four windows)."""
    def pct(k):
        return (f"CASE WHEN p{k} = 0 THEN (CASE WHEN c{k} = 0 THEN CAST('NaN' AS DOUBLE) "
                f"ELSE 0.0 END) ELSE CAST(c{k} AS DOUBLE) / p{k} * 100 END")
    counts = ",\n           ".join(
        f"count(CASE WHEN q = {k} AND n_open > 0 THEN 1 END) AS p{k}, "
        f"count(CASE WHEN q = {k} AND returned = 1 THEN 1 END) AS c{k}" for k in range(1, 5))
    return f"""
WITH s AS ({_g3_slots_sql()}),
pr AS (
    SELECT suppkey, yr, ptype, brand, brand AS descr,
           min(min_size) AS min_size, max(last_ship) AS last_ship,
           {counts}
    FROM (SELECT *, {qexpr} AS q FROM s) GROUP BY 1, 2, 3, 4, 5),
lastpair AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY suppkey, yr, ptype, descr
                                                ORDER BY brand DESC) AS rn FROM pr)
    WHERE rn = 1)
SELECT 'schedule-' || CAST(suppkey AS VARCHAR) AS workbook, CAST(yr - {_YEAR0} AS INTEGER) AS sheet_idx,
       ptype AS Location, descr AS Description, CAST(min_size AS VARCHAR) AS Survey_Frequency,
       'PF-' || lower(ptype) AS Platform_Installation,
       strftime(last_ship, '%Y-%m-%d') AS Last_Inspection,
       {pct(1)} AS Quarter1, {pct(2)} AS Quarter2, {pct(3)} AS Quarter3, {pct(4)} AS Quarter4
FROM lastpair
"""


@register("inspection_program_table", _g3_program_sql("slot // 12 + 1"))
def q_inspection_program_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection_program(catalog.g3(spark, sf_dir)).table


# Operator-level keys register themselves on import (they reuse the SQL
# fragments above).
from cellfold import queries_ops  # noqa: E402,F401
