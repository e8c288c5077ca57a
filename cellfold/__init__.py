"""cellfold: spreadsheet workbooks as long-form Spark tables, and the
label/region operators and KPI programs that run over them.

Bronze tables (all keyed by ``workbook, sheet_idx``):

* ``sheets(workbook, sheet_idx, sheet, sheet_key)``
* ``cells(workbook, sheet_idx, row, col, ctype, num, str, formula, text, text_key)``
* ``merges(workbook, sheet_idx, decl_idx, first_row, last_row, first_col, last_col)``

Everything downstream of the decoder is a DataFrame plan over these.
"""

from cellfold.session import get_session  # noqa: F401
