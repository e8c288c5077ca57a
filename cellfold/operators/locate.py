"""Locate operators: find sheets, labels, anchors and read cells by offset.

Every operator here is a filter plus an aggregation or an equi-join keyed by
``(workbook, sheet_idx, ...)``. Label filters hit the stored ``text_key``
column, so they reach the Parquet scan as pushed filters; the aggregations
that follow run on the few matching cells, with partial (map-side)
aggregation, so a very large sheet never lands in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.functions.metrics import numeric_read, numeric_read_error
from cellfold.functions.text import jtrim, label_key
from cellfold.sources.bronze import BUCKET, MAX_COLS, SHEET_ID, SHEET_ROW, Corpus, buckets_of, deal, keyed

SHEET = ["workbook", "sheet_idx"]


def pos_key(row="row", col="col") -> Column:
    """Row-major position as one BIGINT, so 'last match' is a plain max()."""
    r = F.col(row) if isinstance(row, str) else row
    c = F.col(col) if isinstance(col, str) else col
    return r.cast("bigint") * F.lit(MAX_COLS) + c.cast("bigint")


def pos_row(p) -> Column:
    return F.floor(p / F.lit(MAX_COLS)).cast("int")


def pos_col(p) -> Column:
    return F.pmod(p, F.lit(MAX_COLS)).cast("int")


# --------------------------------------------------------------------------
# P-06 / J-06 sheet pick by name list
# --------------------------------------------------------------------------

def sheet_resolve(sheets: DataFrame, tabs: list[str], policy: str = "issue") -> DataFrame:
    """For every workbook and requested tab: the last sheet whose trimmed,
    lower-cased name equals the lower-cased tab name.

    One aggregation over ``sheets`` (a conditional max per requested tab),
    then a posexplode back to one row per (workbook, tab). No join.

    ``policy='first_sheet'`` falls back to sheet 0 (the source system's
    behaviour); ``policy='issue'`` leaves ``sheet_idx`` NULL and
    ``found=False`` so the caller can route the row to ``issues``.

    Output: workbook, tab_ord, tab, sheet_idx, found.
    """
    keys = [t.lower() for t in tabs]
    per_tab = [F.max(F.when(F.col("sheet_key") == k, F.col("sheet_idx"))) for k in keys]
    agg = sheets.groupBy("workbook").agg(F.array(*per_tab).alias("hits"))
    tab_arr = F.array(*[F.lit(t) for t in tabs])
    out = (agg.select("workbook", F.posexplode(F.arrays_zip(tab_arr.alias("tab"),
                                                            F.col("hits").alias("hit"))))
           .select("workbook", F.col("pos").cast("int").alias("tab_ord"),
                   F.col("col.tab").alias("tab"), F.col("col.hit").alias("hit")))
    found = F.col("hit").isNotNull()
    if policy == "first_sheet":
        idx = F.coalesce(F.col("hit"), F.lit(0))
    elif policy == "issue":
        idx = F.col("hit")
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return out.select("workbook", "tab_ord", "tab", idx.cast("int").alias("sheet_idx"),
                      found.alias("found"))


# --------------------------------------------------------------------------
# P-02 first-column label with unit guard
# --------------------------------------------------------------------------

def find_label_first_col(cells: DataFrame, roles: dict[str, str],
                         guards: dict[str, str] | None = None,
                         label_col: int = 0, guard_col: int = 1) -> DataFrame:
    """Row of each role label in column ``label_col``; last match wins.

    ``roles`` maps role -> label in priority order (the first role whose label
    matches and whose guard passes takes the row). ``guards`` maps role ->
    a raw text that, found in ``guard_col`` of the same row, disqualifies it
    (e.g. the unit '%').

    Output: workbook, sheet_idx, role, row.
    """
    guards = guards or {}
    keys = {r: label_key(lbl) for r, lbl in roles.items()}
    guard_texts = sorted(set(guards.values()))
    pred = (F.col("col") == label_col) & F.col("text_key").isin(list(keys.values()))
    if guard_texts:
        pred = pred | ((F.col("col") == guard_col) & F.col("text").isin(guard_texts))
    per_row = (cells.filter(pred)
               .groupBy(*SHEET, "row")
               .agg(F.max(F.when(F.col("col") == label_col, F.col("text_key"))).alias("k"),
                    F.max(F.when(F.col("col") == guard_col, F.col("text"))).alias("g")))
    role = None
    for r, k in keys.items():
        cond = F.col("k") == k
        if r in guards:
            cond = cond & (F.col("g").isNull() | (F.col("g") != guards[r]))
        role = F.when(cond, F.lit(r)) if role is None else role.when(cond, F.lit(r))
    return (per_row.select(*SHEET, "row", role.alias("role"))
            .filter(F.col("role").isNotNull())
            .groupBy(*SHEET, "role").agg(F.max("row").alias("row")))


# --------------------------------------------------------------------------
# P-03 / A-02 label anywhere, last match in row-major order
# --------------------------------------------------------------------------

def find_label_any(cells: DataFrame, label: str) -> DataFrame:
    """(row, col) of the last cell whose normalised text equals ``label``.

    Sheets without a match have no row (the caller decides: issue or -1).
    Output: workbook, sheet_idx, row, col.
    """
    p = (cells.filter(F.col("text_key") == label_key(label))
         .groupBy(*SHEET).agg(F.max(pos_key()).alias("p")))
    return p.select(*SHEET, pos_row(F.col("p")).alias("row"), pos_col(F.col("p")).alias("col"))


def find_labels_any(cells: DataFrame, labels: dict[str, str]) -> DataFrame:
    """P-03 for several labels in ONE filtered pass: per sheet, for each
    role, the (row, col) of the last cell reading its label (NULL if none).
    Output: workbook, sheet_idx, <role>_row, <role>_col per role."""
    keys = {r: label_key(lbl) for r, lbl in labels.items()}
    p = (cells.filter(F.col("text_key").isin(list(keys.values())))
         .groupBy(*SHEET)
         .agg(*[F.max(F.when(F.col("text_key") == k, pos_key())).alias(r) for r, k in keys.items()]))
    out = [*SHEET]
    for r in keys:
        out += [pos_row(F.col(r)).alias(f"{r}_row"), pos_col(F.col(r)).alias(f"{r}_col")]
    return p.select(*out)


def find_labels_indexed(corpus: Corpus, labels: dict[str, str]) -> DataFrame:
    """P-03 for several labels from the label index: per sheet and role with a match, the
    last cell reading the role's label. Cells of other texts are not read.
    Output: workbook, sheet_idx, role, row, col."""
    roles = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(label_key(lbl)).alias("of_key"))
                      for r, lbl in labels.items()])
    last = (corpus.labelled(sorted({label_key(lbl) for lbl in labels.values()}))
            .groupBy(*SHEET_ID, "text_key").agg(F.max(pos_key()).alias("p"))
            .select(*SHEET_ID, "text_key", "p", F.inline(roles)).filter(F.col("text_key") == F.col("of_key")))
    return (last.join(keyed(corpus.sheets.select(*SHEET)), SHEET_ID)
            .select(*SHEET, "role", pos_row(F.col("p")).alias("row"), pos_col(F.col("p")).alias("col")))


# --------------------------------------------------------------------------
# P-05 / F-03 header anchor on a row whose first column is blank
# --------------------------------------------------------------------------

def find_header_anchor(cells: DataFrame, header: str, blank_col: int = 0) -> DataFrame:
    """Last cell reading ``header`` on a row whose ``blank_col`` cell is blank.

    One filter and two small aggregations: per row, the last header column and
    whether the blank column holds text; then per sheet, the last such row.
    Output: workbook, sheet_idx, row, col.
    """
    key = label_key(header)
    is_hdr = F.col("text_key") == key
    blocks = (F.col("col") == blank_col) & (F.col("text_key") != "")
    per_row = (cells.filter(is_hdr | blocks)
               .groupBy(*SHEET, "row")
               .agg(F.max(F.when(is_hdr, F.col("col"))).alias("hcol"),
                    F.max(F.when(blocks, F.lit(1))).alias("blocked")))
    p = (per_row.filter(F.col("hcol").isNotNull() & F.col("blocked").isNull())
         .groupBy(*SHEET).agg(F.max(pos_key("row", "hcol")).alias("p")))
    return p.select(*SHEET, pos_row(F.col("p")).alias("row"), pos_col(F.col("p")).alias("col"))


# --------------------------------------------------------------------------
# P-07 offset projection and P-08 fixed-width column window
# --------------------------------------------------------------------------

def read_cells(cells: DataFrame, targets: DataFrame, columns: list[str]) -> DataFrame:
    """Left join of target positions (workbook, sheet_idx, row, col and tags) to the
    cells stored there; adds the named columns of cells (NULL where none is stored).

    Targets are dealt to the buckets of the cells, if they are not there yet, so cells stay
    and only targets move; the column picks among the cells of that row (at most 16384).
    Targets that come with the key of the buckets keep it.
    """
    c = keyed(cells).select(*[F.col(x).alias(f"c_{x}") for x in (*SHEET_ROW, "col", *columns)])
    dealt = set(BUCKET) <= set(targets.columns)
    t = targets if dealt else deal(targets, buckets_of(cells))
    same = reduce(lambda a, b: a & b, [t[x] == c[f"c_{x}"] for x in SHEET_ROW])
    # the column is no join key: targets are dealt by bucket, cells sorted by row
    return (t.join(c, same & (c["c_col"] - t["col"] == 0), "left")
            .select(*[x for x in t.columns if dealt or x not in BUCKET],
                    *[F.col(f"c_{x}").alias(x) for x in columns]))


def read_targets(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """``read_cells`` with ctype, num, str, text (NULL ctype = no stored cell), ``value``
    (S-06 numeric view) and ``read_error``."""
    return (read_cells(cells, targets, ["ctype", "num", "str", "text"])
            .withColumn("value", numeric_read())
            .withColumn("read_error", numeric_read_error()))


def offset_lookup(cells: DataFrame, anchors: DataFrame, dr: int = 0, dc: int = 0,
                  tags: list[str] | None = None) -> DataFrame:
    """Cell at (anchor.row + dr, anchor.col + dc) for every anchor row."""
    tags = tags or []
    t = anchors.select(*SHEET, (F.col("row") + dr).alias("row"),
                       (F.col("col") + dc).alias("col"), *tags)
    return read_targets(cells, t)


def column_window(cells: DataFrame, anchors: DataFrame, width: int = 12,
                  tags: list[str] | None = None) -> DataFrame:
    """Cells ``row, start .. start+width-1`` for every anchor (row, start).

    The anchor side is expanded to one target per column (a generator, not a
    join), then read; ``k`` is the 0-based offset.
    """
    tags = tags or []
    t = (anchors.select(*SHEET, "row", F.col("start"), *tags,
                        F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("k"))
         .select(*SHEET, "row", (F.col("start") + F.col("k")).alias("col"), "k", *tags))
    return read_targets(cells, t)


def cell_text_norm(cells: DataFrame) -> DataFrame:
    """P-01/F-01/F-02 applied: raw text, its Java-trimmed form and the key."""
    return cells.select(*SHEET, "row", "col", "text",
                        jtrim(F.coalesce(F.col("text"), F.lit(""))).alias("trimmed"),
                        "text_key")
