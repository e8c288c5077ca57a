"""Formula cells of hand-written sheet XML, and number rendering."""

import io
import zipfile

from cellfold.sources.xlsx import decode_workbook, render_number, shift_formula

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(rows: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{REL}"><sheets>'
                   '<sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{NS}"><sheetData>{rows}</sheetData></worksheet>')
    return out.getvalue()


def test_shared_formulas_read_as_their_own_text():
    cells = [r for r in decode_workbook("w", book(
        '<row r="1"><c r="A1"><v>1</v></c><c r="B1"><f t="shared" ref="B1:B3" si="0">A1+$A$1</f><v>2</v></c></row>'
        '<row r="2"><c r="B2"><f t="shared" si="0"/><v>3</v></c></row>'
        '<row r="3"><c r="B3"><f t="shared" si="0"/><v>4</v></c></row>')) if r["kind"] == "cell"]
    assert [(c["row"], c["text"], c["num"]) for c in cells if c["col"] == 1] == [
        (0, "A1+$A$1", 2.0), (1, "A2+$A$1", 3.0), (2, "A3+$A$1", 4.0)]


def test_shift_leaves_names_and_quotes():
    assert shift_formula('SUM(A1:$B2)+LOG10(C3)&"A1"&\'A1 x\'!AZ9', 1, 1) == 'SUM(B2:$B3)+LOG10(D4)&"A1"&\'A1 x\'!BA10'
    assert shift_formula("A1", -1, 0) == "#REF!"


def test_numbers_are_not_cut():
    assert [render_number(v) for v in (5e-11, 0.1 + 0.2, 1200.0, -0.0, 1.25, 1e-7)] == [
        "0.00000000005", "0.3", "1200", "0", "1.25", "0.0000001"]
