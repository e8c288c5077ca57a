"""Small golden workbooks for tests, written as real xlsx bytes and decoded
through the engine's own Spark decoder.

A book is {sheet name: {"cells": {(row, col): value}, "merges": [(r0, r1, c0, c1)]}}
(a list of (name, sheet) pairs keeps duplicate names). Cell values:
str -> string, int/float -> numeric, None -> blank, bool -> boolean,
("f", formula, cached) -> formula, ("e", code) -> error.
"""

from __future__ import annotations

from cellfold.sources.xlsx import build_xlsx, decode, to_corpus


def _cell(r, c, v):
    if isinstance(v, tuple) and v[0] == "f":
        cached = v[2]
        if isinstance(cached, str):
            return (r, c, "formula", None, cached, v[1])
        return (r, c, "formula", cached, None, v[1])
    if isinstance(v, tuple) and v[0] == "e":
        return (r, c, "error", None, v[1], None)
    if isinstance(v, bool):
        return (r, c, "boolean", 1.0 if v else 0.0, None, None)
    if v is None:
        return (r, c, "blank", None, None, None)
    if isinstance(v, (int, float)):
        return (r, c, "numeric", float(v), None, None)
    return (r, c, "string", None, v, None)


def book_bytes(book) -> bytes:
    items = book.items() if isinstance(book, dict) else book
    sheets = []
    for name, sh in items:
        cells = [_cell(r, c, v) for (r, c), v in sh.get("cells", {}).items()]
        sheets.append({"name": name, "cells": cells, "merges": sh.get("merges", [])})
    return build_xlsx(sheets)


def corpus_of(spark, books: dict):
    """{workbook: book} -> (Corpus, decode errors) via the Spark decoder."""
    rows = [(wb, book_bytes(b) if not isinstance(b, bytes) else b) for wb, b in books.items()]
    files = spark.createDataFrame(rows, "workbook string, content binary")
    return to_corpus(decode(files))


MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
METERED = "Total Metered Production"
UNPLANNED = "Total Actual Unplanned Deferment (UPD) - WORPE"


def metric_sheet(metered, unplanned, start=2, header_row=0, extra=None):
    """F1 layout: header row with blank col 0, metered row, unplanned row."""
    cells = {}
    for k in range(12):
        cells[(header_row, start + k)] = MONTHS[k]
    cells[(header_row + 1, 0)] = METERED
    cells[(header_row + 1, 1)] = "bbl"
    cells[(header_row + 2, 0)] = UNPLANNED
    cells[(header_row + 2, 1)] = "bbl"
    for k, v in enumerate(metered):
        if v is not Ellipsis:
            cells[(header_row + 1, start + k)] = v
    for k, v in enumerate(unplanned):
        if v is not Ellipsis:
            cells[(header_row + 2, start + k)] = v
    cells.update(extra or {})
    return {"cells": cells}
