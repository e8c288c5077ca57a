"""S-01 workbook scan: xlsx bytes -> bronze ``sheets``/``cells``/``merges``.

Spark lists and reads the files (``binaryFile``: path, length and content;
filters on path/length are pushed into the listing), and ONE ``mapInArrow``
pass decodes each file with the standard library (zip + streaming XML) into
Arrow record batches of about 10k records. Every record carries a ``kind``
(sheet, cell, merge, error), so one decode feeds all three bronze tables;
a file that cannot be read becomes an ``error`` record, never a task
failure. Decode once and persist the bronze tables (``write_corpus``): the
decoder is opaque to the optimizer, the bronze Parquet is not.

A single workbook is decoded by one task (a zip is not splittable); many
workbooks spread over all tasks.

Rendering of the formatted-text view (``text``): strings as stored, numbers
in a General-like form (integers without a point, otherwise up to 10
decimals), booleans TRUE/FALSE, errors as their code, formulas as their
source text (no evaluation, like a formatter without an evaluator), dates
from date-styled numbers as ISO dates or 'Month yyyy'.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.sources.bronze import Corpus, finish_cells, with_sheet_key

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PR = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_REF = re.compile(r"^([A-Z]+)([0-9]+)$")
BATCH_ROWS = 10_000

DECODED_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("workbook", T.StringType()),
    T.StructField("sheet_idx", T.IntegerType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("row", T.IntegerType()),
    T.StructField("col", T.IntegerType()),
    T.StructField("ctype", T.StringType()),
    T.StructField("num", T.DoubleType()),
    T.StructField("str", T.StringType()),
    T.StructField("formula", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("decl_idx", T.IntegerType()),
    T.StructField("first_row", T.IntegerType()),
    T.StructField("last_row", T.IntegerType()),
    T.StructField("first_col", T.IntegerType()),
    T.StructField("last_col", T.IntegerType()),
    T.StructField("reason", T.StringType()),
])
_FIELDS = [f.name for f in DECODED_SCHEMA.fields]

# Built-in number formats that are dates (ECMA-376 ids 14-22, 45-47).
_DATE_FMT_IDS = set(range(14, 23)) | {45, 46, 47}
_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
           "September", "October", "November", "December"]


def col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def col_letters(idx: int) -> str:
    s, n = "", idx + 1
    while n:
        n, r = divmod(n - 1, 26)
        s = chr(65 + r) + s
    return s


def _parse_ref(ref: str) -> tuple[int, int]:
    m = _REF.match(ref)
    if not m:
        raise ValueError(f"bad cell reference {ref!r}")
    return int(m.group(2)) - 1, col_index(m.group(1))


def render_number(v: float) -> str:
    """General-like rendering: plain digits with up to 15 significant ones."""
    if v != v or v in (float("inf"), float("-inf")):
        return str(v)
    if v == int(v) and abs(v) < 1e15:
        return str(int(v))
    return format(Decimal(f"{v:.15g}"), "f")


_QUOTED = re.compile(r'"[^"]*"|\'[^\']*\'')
_CELL = re.compile(r"(?<![A-Za-z0-9_.$])(\$?)([A-Z]{1,3})(\$?)([0-9]{1,7})(?![A-Za-z0-9_.(!])")


def shift_formula(formula: str, rows: int, cols: int) -> str:
    """A shared formula as it reads in another cell: relative references move along."""
    def move(m: re.Match) -> str:
        col, row = col_index(m[2]), int(m[4])
        if not m[1]:
            col += cols
        if not m[3]:
            row += rows
        if col < 0 or row < 1:
            return "#REF!"
        name = ""
        col += 1
        while col:
            col, k = divmod(col - 1, 26)
            name = chr(65 + k) + name
        return f"{m[1]}{name}{m[3]}{row}"

    out, at = [], 0
    for q in _QUOTED.finditer(formula):
        out += [_CELL.sub(move, formula[at:q.start()]), q[0]]
        at = q.end()
    return "".join(out) + _CELL.sub(move, formula[at:])


def _excel_date(v: float, date1904: bool) -> _dt.datetime:
    base = _dt.datetime(1904, 1, 1) if date1904 else _dt.datetime(1899, 12, 30)
    return base + _dt.timedelta(days=v)


def _text_of(node) -> str:
    """Concatenated text of all <t> under a node (rich-text runs included)."""
    return "".join(t.text or "" for t in node.iter(f"{_M}t"))


class _Styles:
    def __init__(self, zf: zipfile.ZipFile):
        self.date_style: list[str | None] = []
        try:
            root = ET.fromstring(zf.read("xl/styles.xml"))
        except KeyError:
            return
        custom = {}
        fmts = root.find(f"{_M}numFmts")
        if fmts is not None:
            for nf in fmts.findall(f"{_M}numFmt"):
                custom[int(nf.get("numFmtId"))] = nf.get("formatCode") or ""
        xfs = root.find(f"{_M}cellXfs")
        if xfs is None:
            return
        for xf in xfs.findall(f"{_M}xf"):
            fid = int(xf.get("numFmtId") or 0)
            code = custom.get(fid, "")
            low = re.sub(r'"[^"]*"|\[[^\]]*\]', "", code.lower())
            if "mmmm" in low and "y" in low:
                self.date_style.append("month_year")
            elif fid in _DATE_FMT_IDS or (("y" in low or "d" in low) and "m" in low):
                self.date_style.append("date")
            else:
                self.date_style.append(None)

    def kind(self, s: str | None) -> str | None:
        if s is None:
            return None
        i = int(s)
        return self.date_style[i] if i < len(self.date_style) else None


def _sheet_parts(zf: zipfile.ZipFile) -> tuple[list[tuple[str, str]], bool]:
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    pr = wb.find(f"{_M}workbookPr")
    date1904 = pr is not None and pr.get("date1904") in ("1", "true")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.findall(f"{_PR}Relationship")}
    out = []
    for s in wb.find(f"{_M}sheets").findall(f"{_M}sheet"):
        t = target[s.get(f"{_R}id")]
        part = t.lstrip("/") if t.startswith("/") else "xl/" + t
        out.append((s.get("name"), part))
    return out, date1904


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    try:
        data = zf.open("xl/sharedStrings.xml")
    except KeyError:
        return []
    out = []
    for _, el in ET.iterparse(data, events=("end",)):
        if el.tag == f"{_M}si":
            out.append(_text_of(el))
            el.clear()
    return out


def decode_workbook(workbook: str, content: bytes) -> Iterator[dict]:
    """Yield sheet, cell and merge records of one xlsx file (or one error)."""
    try:
        zf = zipfile.ZipFile(io.BytesIO(content))
        sheets, date1904 = _sheet_parts(zf)
        sst = _shared_strings(zf)
        styles = _Styles(zf)
    except Exception as e:  # unreadable file -> one error record
        yield {"kind": "error", "workbook": workbook, "reason": f"{type(e).__name__}: {e}"}
        return
    for idx, (name, part) in enumerate(sheets):
        yield {"kind": "sheet", "workbook": workbook, "sheet_idx": idx, "sheet": name}
        try:
            yield from _decode_sheet(zf, workbook, idx, part, sst, styles, date1904)
        except Exception as e:
            yield {"kind": "error", "workbook": workbook, "sheet_idx": idx,
                   "reason": f"{type(e).__name__}: {e}"}


def _decode_sheet(zf, workbook, idx, part, sst, styles, date1904) -> Iterator[dict]:
    row_no, next_col, decl = -1, 0, 0
    shared: dict[str, tuple[str, int, int]] = {}  # master formula and its cell, by group
    rows = None
    for ev, el in ET.iterparse(zf.open(part), events=("start", "end")):
        tag = el.tag
        if ev == "start":
            if tag == f"{_M}sheetData":
                rows = el
            if tag == f"{_M}row":
                r = el.get("r")
                row_no = int(r) - 1 if r else row_no + 1
                next_col = 0
            continue
        if tag == f"{_M}c":
            ref = el.get("r")
            r, c = _parse_ref(ref) if ref else (row_no, next_col)
            next_col = c + 1
            yield _cell_record(workbook, idx, r, c, el, sst, styles, date1904, shared)
            el.clear()
        elif tag == f"{_M}row" and rows is not None:
            rows.clear()  # with its parent's list, so memory does not grow with the rows
        elif tag == f"{_M}mergeCell":
            a, _, b = el.get("ref").partition(":")
            (r0, c0), (r1, c1) = _parse_ref(a), _parse_ref(b or a)
            yield {"kind": "merge", "workbook": workbook, "sheet_idx": idx, "decl_idx": decl,
                   "first_row": r0, "last_row": r1, "first_col": c0, "last_col": c1}
            decl += 1


def _cell_record(workbook, idx, r, c, el, sst, styles, date1904, shared) -> dict:
    t = el.get("t")
    f = el.find(f"{_M}f")
    v = el.find(f"{_M}v")
    vtext = v.text if v is not None else None
    rec = {"kind": "cell", "workbook": workbook, "sheet_idx": idx, "row": r, "col": c}
    num = s = None
    if t == "s":
        s = sst[int(vtext)] if vtext is not None else ""
    elif t == "inlineStr":
        isn = el.find(f"{_M}is")
        s = _text_of(isn) if isn is not None else ""
    elif t == "str":
        s = vtext or ""
    elif t == "b":
        num = None
    elif t == "e":
        s = vtext or ""
    elif vtext is not None:
        num = float(vtext)
    if f is not None:
        formula = f.text or ""
        if f.get("t") == "shared":
            if formula:
                shared[f.get("si")] = formula, r, c
            elif f.get("si") in shared:
                master, r0, c0 = shared[f.get("si")]
                formula = shift_formula(master, r - r0, c - c0)
        rec.update(ctype="formula", formula=formula, text=formula,
                   num=num, str=s if t in ("str", "s", "inlineStr") else None)
        return rec
    if t in ("s", "inlineStr", "str"):
        rec.update(ctype="string", str=s, text=s)
    elif t == "b":
        b = vtext in ("1", "true")
        rec.update(ctype="boolean", num=1.0 if b else 0.0, text="TRUE" if b else "FALSE")
    elif t == "e":
        rec.update(ctype="error", text=s)
    elif num is None:
        rec.update(ctype="blank", text="")
    else:
        kind = styles.kind(el.get("s"))
        if kind is not None:
            d = _excel_date(num, date1904)
            text = (f"{_MONTHS[d.month - 1]} {d.year}" if kind == "month_year"
                    else d.strftime("%Y-%m-%d"))
        else:
            text = render_number(num)
        rec.update(ctype="numeric", num=num, text=text)
    return rec


def _to_batch(rows: list[dict]) -> pa.RecordBatch:
    cols = {k: [r.get(k) for r in rows] for k in _FIELDS}
    return pa.RecordBatch.from_pydict(cols, schema=_ARROW_SCHEMA)


_ARROW_SCHEMA = pa.schema([
    pa.field(f.name, {T.StringType: pa.string(), T.IntegerType: pa.int32(),
                      T.DoubleType: pa.float64()}[type(f.dataType)]) for f in DECODED_SCHEMA.fields])


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buf: list[dict] = []
    for b in batches:
        for name, content in zip(b.column("workbook"), b.column("content")):  # one file at a time
            for rec in decode_workbook(name.as_py(), content.as_py() or b""):
                buf.append(rec)
                if len(buf) >= BATCH_ROWS:
                    yield _to_batch(buf)
                    buf = []
    if buf:
        yield _to_batch(buf)


def decode(files: DataFrame) -> DataFrame:
    """``files``: workbook (its identity, e.g. the path) and content (bytes).
    Returns the decoded record stream (``DECODED_SCHEMA``)."""
    return files.select("workbook", "content").mapInArrow(_decode_batches, DECODED_SCHEMA)


def list_workbooks(spark: SparkSession, path: str, glob: str = "*.xlsx",
                   recursive: bool = True) -> DataFrame:
    """binaryFile listing of workbook files (path, length, content)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower()).load(path)
            .select(F.col("path").alias("workbook"), "length", "content"))


def to_corpus(decoded: DataFrame) -> tuple[Corpus, DataFrame]:
    """Split a (persisted) decoded stream into the bronze tables + error rows."""
    sheets = with_sheet_key(decoded.filter(F.col("kind") == "sheet")
                            .select("workbook", "sheet_idx", "sheet"))
    cells = finish_cells(decoded.filter(F.col("kind") == "cell"))
    merges = decoded.filter(F.col("kind") == "merge").select(
        "workbook", "sheet_idx", "decl_idx", "first_row", "last_row", "first_col", "last_col")
    errors = decoded.filter(F.col("kind") == "error").select(
        "workbook", "sheet_idx", F.lit("xlsx_decode").alias("operator"), "reason")
    return Corpus(sheets, cells, merges), errors


def ingest(spark: SparkSession, path: str, bronze_path: str | None = None) -> tuple[Corpus, DataFrame]:
    """Decode every workbook under ``path``. With ``bronze_path`` the decoded
    stream is written once as Parquet and the bronze tables read from it."""
    decoded = decode(list_workbooks(spark, path))
    if bronze_path:
        decoded.write.mode("overwrite").partitionBy("kind").parquet(bronze_path)
        decoded = spark.read.parquet(bronze_path)
    return to_corpus(decoded)


# ---------------------------------------------------------------------------
# Writer (fixtures and round trips): cell records -> xlsx bytes
# ---------------------------------------------------------------------------

def _esc(s: str) -> str:
    return (s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
            .replace('"', "&quot;"))


def _keep_space(s: str) -> str:
    return ' xml:space="preserve"' if s != s.strip() else ""


def build_xlsx(sheets: list[dict]) -> bytes:
    """``sheets``: [{name, cells: [(row, col, ctype, num, str, formula)], merges:
    [(first_row, last_row, first_col, last_col)]}] -> xlsx file bytes."""
    sst: dict[str, int] = {}
    sheet_xml = []
    for sh in sheets:
        rows: dict[int, list] = {}
        for cell in sorted(sh.get("cells", []), key=lambda x: (x[0], x[1])):
            rows.setdefault(cell[0], []).append(cell)
        out = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>',
               f'<worksheet xmlns="{_M[1:-1]}" xmlns:r="{_R[1:-1]}"><sheetData>']
        for r in sorted(rows):
            out.append(f'<row r="{r + 1}">')
            for (_, c, ctype, num, s, formula) in rows[r]:
                ref = f"{col_letters(c)}{r + 1}"
                if ctype == "string":
                    i = sst.setdefault(s, len(sst))
                    out.append(f'<c r="{ref}" t="s"><v>{i}</v></c>')
                elif ctype == "numeric":
                    out.append(f'<c r="{ref}"><v>{repr(float(num))}</v></c>')
                elif ctype == "boolean":
                    out.append(f'<c r="{ref}" t="b"><v>{1 if num else 0}</v></c>')
                elif ctype == "error":
                    out.append(f'<c r="{ref}" t="e"><v>{_esc(s or "#N/A")}</v></c>')
                elif ctype == "formula":
                    if s is not None:
                        out.append(f'<c r="{ref}" t="str"><f>{_esc(formula)}</f><v>{_esc(s)}</v></c>')
                    else:
                        v = "" if num is None else f"<v>{repr(float(num))}</v>"
                        out.append(f'<c r="{ref}"><f>{_esc(formula)}</f>{v}</c>')
                else:  # blank: a styled cell without a value
                    out.append(f'<c r="{ref}" s="0"/>')
            out.append("</row>")
        out.append("</sheetData>")
        merges = sh.get("merges", [])
        if merges:
            out.append(f'<mergeCells count="{len(merges)}">')
            for (r0, r1, c0, c1) in merges:
                out.append(f'<mergeCell ref="{col_letters(c0)}{r0 + 1}:{col_letters(c1)}{r1 + 1}"/>')
            out.append("</mergeCells>")
        out.append("</worksheet>")
        sheet_xml.append("".join(out))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        n = len(sheets)
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType='
                             '"application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                             for i in range(n))
                   + '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>'
                   '</Types>')
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   f'<Relationships xmlns="{_PR[1:-1]}"><Relationship Id="rId1" '
                   'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
                   'Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   f'<workbook xmlns="{_M[1:-1]}" xmlns:r="{_R[1:-1]}"><sheets>'
                   + "".join(f'<sheet name="{_esc(sh["name"])}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                             for i, sh in enumerate(sheets))
                   + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   f'<Relationships xmlns="{_PR[1:-1]}">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/'
                             f'officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                             for i in range(n))
                   + f'<Relationship Id="rId{n + 1}" Type="http://schemas.openxmlformats.org/'
                     'officeDocument/2006/relationships/sharedStrings" Target="sharedStrings.xml"/>'
                   + "</Relationships>")
        strings = sorted(sst.items(), key=lambda kv: kv[1])
        z.writestr("xl/sharedStrings.xml",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   f'<sst xmlns="{_M[1:-1]}" count="{len(strings)}" uniqueCount="{len(strings)}">'
                   + "".join(f"<si><t{_keep_space(s)}>{_esc(s)}</t></si>" for s, _ in strings)
                   + "</sst>")
        for i, xml in enumerate(sheet_xml):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", xml)
    return buf.getvalue()


_WRITE_SCHEMA = "workbook string, content binary"


def _pack_workbook(pdf):
    """applyInPandas body: all records of one workbook -> one xlsx file."""
    import pandas as pd
    wb = pdf["workbook"].iloc[0]
    sheets_meta = pdf[pdf["kind"] == "sheet"].sort_values("sheet_idx")
    by_idx = {int(i): {"name": n, "cells": [], "merges": []}
              for i, n in zip(sheets_meta["sheet_idx"], sheets_meta["sheet"])}
    for r in pdf[pdf["kind"] == "cell"].itertuples(index=False):
        num = None if pd.isna(r.num) else float(r.num)
        s = None if r.str is None or (isinstance(r.str, float) and pd.isna(r.str)) else r.str
        fml = None if r.formula is None or (isinstance(r.formula, float)) else r.formula
        by_idx[int(r.sheet_idx)]["cells"].append((int(r.row), int(r.col), r.ctype, num, s, fml))
    merges = pdf[pdf["kind"] == "merge"].sort_values(["sheet_idx", "decl_idx"])
    for r in merges.itertuples(index=False):
        by_idx[int(r.sheet_idx)]["merges"].append(
            (int(r.first_row), int(r.last_row), int(r.first_col), int(r.last_col)))
    ordered = [by_idx[i] for i in sorted(by_idx)]
    return pd.DataFrame({"workbook": [wb], "content": [build_xlsx(ordered)]})


def corpus_to_xlsx(corpus: Corpus) -> DataFrame:
    """Render every workbook of a corpus as xlsx bytes: (workbook, content).

    Records are shuffled by workbook and each workbook is assembled by one
    group (a file is one unit); used to make test workbooks from grids."""
    recs = (corpus.sheets.select(F.lit("sheet").alias("kind"), "workbook", "sheet_idx", "sheet")
            .unionByName(corpus.cells.select(F.lit("cell").alias("kind"), "workbook", "sheet_idx",
                                             "row", "col", "ctype", "num", "str", "formula"),
                         allowMissingColumns=True)
            .unionByName(corpus.merges.select(F.lit("merge").alias("kind"), "workbook",
                                              "sheet_idx", "decl_idx", "first_row", "last_row",
                                              "first_col", "last_col"),
                         allowMissingColumns=True))
    return recs.groupBy("workbook").applyInPandas(_pack_workbook, _WRITE_SCHEMA)
