"""Side-by-side check of a registered query against its DuckDB oracle:
row count, column names, and an order-insensitive comparison of values
(doubles compared after rounding to 9 significant digits; NaN == NaN)."""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("0null",)
    if isinstance(v, bool):
        return ("b", int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if math.isinf(v):
            return ("inf", v > 0)
        return ("f", float(f"{v:.9g}"))
    if isinstance(v, int):
        return ("f", float(f"{float(v):.9g}"))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if hasattr(v, "asDict"):
        return ("r", tuple(_norm(x) for x in v))
    return ("s", str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, key, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    out["values_match"] = out["cols_match"] and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    elif not out["values_match"]:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        sa, sb = set(a), set(b)
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_oracle"] = [r for r in b if r not in sa][:3]
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from cellfold.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_session()
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in qs:
        if only and k not in only:
            continue
        if k not in sqls:
            n = qs[k](spark, sf).count()
            print({"key": k, "spark_rows": n, "oracle": None})
            continue
        r = compare(spark, k, qs[k], sqls[k], sf, con)
        bad += not r["values_match"]
        print(r, flush=True)
    print("MISMATCHES", bad)
