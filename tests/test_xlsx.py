"""S-01 decoder: xlsx details, and the binaryFile path end to end."""

import io
import zipfile

from cellfold.sources.xlsx import build_xlsx, decode_workbook, ingest, render_number
from tests.books import book_bytes, corpus_of


def test_cell_types_and_merges(spark):
    book = {"Data ": {"cells": {(0, 0): " Label\t", (0, 2): 170, (1, 1): None,
                                (2, 0): ("f", "SUM(C1:C1)", 170.0), (2, 1): ("f", "A1", "txt"),
                                (3, 0): True, (3, 1): ("e", "#DIV/0!"), (4, 27): 0.125},
                      "merges": [(0, 1, 0, 3), (5, 5, 0, 0)]},
            "Two": {"cells": {}}}
    corpus, errors = corpus_of(spark, {"wb": book})
    assert errors.count() == 0
    cells = {(r["row"], r["col"]): r for r in corpus.cells.collect()}
    assert cells[(0, 0)]["ctype"] == "string" and cells[(0, 0)]["text_key"] == "label"
    assert cells[(0, 2)]["num"] == 170.0 and cells[(0, 2)]["text"] == "170"
    assert cells[(1, 1)]["ctype"] == "blank" and cells[(1, 1)]["text"] == ""
    f = cells[(2, 0)]
    assert (f["ctype"], f["num"], f["text"]) == ("formula", 170.0, "SUM(C1:C1)")
    assert cells[(2, 1)]["str"] == "txt"
    assert cells[(3, 0)]["text"] == "TRUE" and cells[(3, 1)]["text"] == "#DIV/0!"
    assert cells[(4, 27)]["text"] == "0.125"
    sheets = sorted((r["sheet_idx"], r["sheet"], r["sheet_key"]) for r in corpus.sheets.collect())
    assert sheets == [(0, "Data ", "data"), (1, "Two", "two")]
    merges = sorted(tuple(r)[2:] for r in corpus.merges.collect())
    assert merges == [(0, 0, 1, 0, 3), (1, 5, 5, 0, 0)]


def test_inline_rich_text_and_cells_without_reference():
    sheet = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
             '<sheetData><row r="3"><c t="inlineStr"><is><r><t>Hel</t></r><r><t>lo</t></r></is></c>'
             '<c><v>2.5</v></c></row><row><c t="b"><v>0</v></c></row></sheetData></worksheet>')
    base = build_xlsx([{"name": "S", "cells": []}])
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(base)) as zin, zipfile.ZipFile(out, "w") as zout:
        for item in zin.infolist():
            data = zin.read(item.filename)
            if item.filename == "xl/worksheets/sheet1.xml":
                data = sheet.encode()
            zout.writestr(item, data)
    recs = [r for r in decode_workbook("wb", out.getvalue()) if r["kind"] == "cell"]
    got = [(r["row"], r["col"], r["ctype"], r.get("text")) for r in recs]
    assert got == [(2, 0, "string", "Hello"), (2, 1, "numeric", "2.5"), (3, 0, "boolean", "FALSE")]


def test_date_styles_render():
    styles = ('<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
              '<numFmts count="1"><numFmt numFmtId="164" formatCode="mmmm yyyy"/></numFmts>'
              '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/>'
              '</cellXfs></styleSheet>')
    sheet = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
             '<sheetData><row r="1"><c r="A1" s="1"><v>43101</v></c><c r="B1" s="2"><v>43101</v></c>'
             '</row></sheetData></worksheet>')
    base = build_xlsx([{"name": "S", "cells": []}])
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(base)) as zin, zipfile.ZipFile(out, "w") as zout:
        for item in zin.infolist():
            data = zin.read(item.filename)
            if item.filename == "xl/worksheets/sheet1.xml":
                data = sheet.encode()
            zout.writestr(item, data)
        zout.writestr("xl/styles.xml", styles)
    recs = [r for r in decode_workbook("wb", out.getvalue()) if r["kind"] == "cell"]
    assert [r["text"] for r in recs] == ["2018-01-01", "January 2018"]


def test_bad_file_is_an_error_record(spark):
    corpus, errors = corpus_of(spark, {"good": book_bytes({"S": {"cells": {(0, 0): "x"}}}),
                                       "bad": b"not a zip"})
    (e,) = errors.collect()
    assert e["workbook"] == "bad" and "BadZipFile" in e["reason"]
    assert corpus.cells.count() == 1


def test_binary_file_listing(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"book{i}.xlsx").write_bytes(book_bytes({"S": {"cells": {(0, 0): f"v{i}"}}}))
    (tmp_path / "notes.txt").write_text("ignored")
    corpus, errors = ingest(spark, str(tmp_path), bronze_path=str(tmp_path / "bronze"))
    assert errors.count() == 0
    texts = sorted(r["text"] for r in corpus.cells.collect())
    assert texts == ["v0", "v1", "v2"]
    assert all(r["workbook"].endswith(".xlsx") for r in corpus.sheets.collect())


def test_render_number():
    assert render_number(170.0) == "170"
    assert render_number(-3.0) == "-3"
    assert render_number(0.1 + 0.2) == "0.3"
    assert render_number(1.5) == "1.5"
