"""T-02 form record on golden workbooks (layout F2) and its quirks."""

import math

from cellfold.plans.form import form_record
from cellfold.sources.grids import FORM_LABELS, FORM_SHEET
from tests.books import corpus_of

V = 21  # value column offset from the label


def form_sheet(values: dict, label_col=0, order=None, drop=(), short_planned=False):
    """F2 layout: each field a merged block starting on its label row."""
    layout = {"total": 1, "outdated": 1, "last_year": 1, "planned": 4, "reviewed": 4,
              "carried": 4, "pct": 4, "element": 5}
    if short_planned:
        layout["planned"] = 3
    cells, merges, row = {}, [], 1
    for f in (order or list(layout)):
        if f in drop:
            continue
        h = layout[f]
        cells[(row, label_col)] = FORM_LABELS[f]
        merges.append((row, row + h - 1, label_col, label_col + 20))
        vals = values.get(f, [])
        for i, v in enumerate(vals if isinstance(vals, list) else [vals]):
            if v is not Ellipsis:
                cells[(row + i, label_col + V)] = v
        row += h
    return {"cells": cells, "merges": merges}


BASE = {"total": "52 + 3", "outdated": "4", "last_year": "2017",
        "planned": [4, "", 2, 5], "reviewed": [3, None, 1, 5], "carried": ["1", "0", ..., "2"],
        "pct": ["0.876", "-0.2", "0.5", "1"], "element": ["a", "b", "c", "d", "e"]}


def run(spark, sheet, sheet_name=FORM_SHEET, **kw):
    corpus, errors = corpus_of(spark, {"wb": {"Cover": {"cells": {(0, 0): "c"}},
                                              sheet_name: sheet}})
    assert errors.count() == 0
    return form_record(corpus, **kw)


def test_fixture_examples(spark):
    res = run(spark, form_sheet(BASE), include_parsed=True)
    (r,) = res.table.collect()
    assert r["Document_Id"] == 1 and r["Year"] == 2018
    assert r["Op_Procedures"] == 55                 # "52 + 3"
    assert r["Number_Of_outdatedOPs"] == 4
    assert r["Last_Updated_OP_Year"] == "2017"
    assert [r[f"Planned_for_Review_Q{q}"] for q in range(1, 5)] == [4, 0, 2, 5]
    assert [r[f"Carried_Forward_Procedure_Q{q}"] for q in range(1, 5)] == [1, 0, 0, 2]
    assert [r[f"Perc_of_Procedure_Rvd_Vs__Plnd_Q{q}"] for q in range(1, 5)] == [88.0, 0.0, 50.0, 100.0]
    assert [r[f"Procedures_Reviewed_Q{q}"] for q in range(1, 5)] == [3, 0, 1, 5]
    assert r["Element"] == ["a", "b", "d", "e"]     # index 2 dropped
    assert res.issues.count() == 0


def test_label_column_anywhere_and_sheet_name_normalised(spark):
    res = run(spark, form_sheet(BASE, label_col=3), sheet_name="  form - DOCUMENT_q1 2018 ")
    (r,) = res.table.collect()
    assert r["Op_Procedures"] == 55


def test_all_planned_zero_gives_nan(spark):
    vals = dict(BASE, planned=["", "", 0, ...])
    (r,) = run(spark, form_sheet(vals)).table.collect()
    assert all(math.isnan(r[f"Perc_of_Procedure_Rvd_Vs__Plnd_Q{q}"]) for q in range(1, 5))


def test_unmerged_label_ignored_and_first_declared_height(spark):
    sheet = form_sheet(BASE)
    # decoy label on a row where no region starts
    sheet["cells"].update({(40, 0): "Number planned for review", (40, V): 999})
    # a later-declared 2-row region on the planned row does not change its height
    planned_row = [k for k, v in sheet["cells"].items() if v == FORM_LABELS["planned"]][0][0]
    sheet["merges"].append((planned_row, planned_row + 1, V + 2, V + 3))
    (r,) = run(spark, sheet).table.collect()
    assert [r[f"Planned_for_Review_Q{q}"] for q in range(1, 5)] == [4, 0, 2, 5]


def test_arith_variants(spark):
    for text, want in [("1 + 2 + 3", 4), ("7 - 2", 5), ("3 * 4", 12), ("12", 12)]:
        (r,) = run(spark, form_sheet(dict(BASE, total=text))).table.collect()
        assert r["Op_Procedures"] == want, text
    res = run(spark, form_sheet(dict(BASE, total="3 / 4")))
    (r,) = res.table.collect()
    assert r["Op_Procedures"] is None
    assert any("not an integer in total" in i["reason"] for i in res.issues.collect())


def test_q05_bad_percent_text(spark):
    res = run(spark, form_sheet(dict(BASE, pct=["abc", "0.5", 0.25, "0.1"])))
    (r,) = res.table.collect()
    p = [r[f"Perc_of_Procedure_Rvd_Vs__Plnd_Q{q}"] for q in range(1, 5)]
    assert math.isnan(p[0]) and p[1] == 50.0 and math.isnan(p[2]) and p[3] == 10.0
    assert [i["reason"] for i in res.issues.collect()] == ["percent text not a decimal"]


def test_q06_absent_labels_default_null_compat_sentinels(spark):
    sheet = form_sheet(BASE, drop=("total", "outdated", "last_year", "pct"))
    (d,) = run(spark, sheet).table.collect()
    assert d["Op_Procedures"] is None and d["Last_Updated_OP_Year"] is None
    assert d["Perc_of_Procedure_Rvd_Vs__Plnd_Q1"] is None
    (c,) = run(spark, sheet, compat=True).table.collect()
    assert c["Op_Procedures"] == 2147483647 and c["Number_Of_outdatedOPs"] == 2147483647
    assert c["Last_Updated_OP_Year"] == ""
    assert math.isnan(c["Perc_of_Procedure_Rvd_Vs__Plnd_Q1"])


def test_q08_percent_before_planned(spark):
    order = ["total", "outdated", "last_year", "pct", "planned", "reviewed", "carried", "element"]
    sheet = form_sheet(BASE, order=order)
    (d,) = run(spark, sheet).table.collect()
    assert d["Perc_of_Procedure_Rvd_Vs__Plnd_Q1"] == 88.0
    (c,) = run(spark, sheet, compat=True).table.collect()
    assert math.isnan(c["Perc_of_Procedure_Rvd_Vs__Plnd_Q1"])


def test_q08_two_planned_blocks(spark):
    """compat: the % block knows the planned block before it, not the last one."""
    sheet = form_sheet(BASE)
    after = max(r for r, _ in sheet["cells"]) + 2
    sheet["cells"][(after, 0)] = FORM_LABELS["planned"]
    sheet["merges"].append((after, after + 3, 0, 20))
    for i in range(4):
        sheet["cells"][(after + i, V)] = 0
    (c,) = run(spark, sheet, compat=True).table.collect()
    assert [c[f"Planned_for_Review_Q{q}"] for q in range(1, 5)] == [0] * 4  # the last block
    assert c["Perc_of_Procedure_Rvd_Vs__Plnd_Q1"] == 88.0
    (d,) = run(spark, sheet).table.collect()
    assert math.isnan(d["Perc_of_Procedure_Rvd_Vs__Plnd_Q1"])


def test_q11_missing_form_sheet(spark):
    res = run(spark, form_sheet(BASE), sheet_name="Another sheet")
    assert res.table.count() == 0
    assert [i["reason"] for i in res.issues.collect()] == ["form sheet not found"]


def test_q12_short_quarter_block(spark):
    res = run(spark, form_sheet(BASE, short_planned=True))
    assert any("shorter than 4 rows: planned" in i["reason"] for i in res.issues.collect())
