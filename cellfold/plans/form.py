"""T-02 form record: one wide row of procedure-review figures per form sheet.

The eight labels are data (``FORM_FIELDS``), not code: one filtered pass over
``cells`` finds every label, a join keeps those on a row where a merged region
starts (the first declared region there fixes the block height), the last
occurrence per field wins, the block's member rows are read 21 columns to the
right (``cellfold.plans.reading``), and a conditional aggregation per sheet
folds the label/value rows into one record (an EAV pivot).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.functions.metrics import guarded_percent, nan, string_read, text_percent
from cellfold.functions.text import (arith_text_eval, blank_to_zero_int, formatted_text,
                                     jtrim, label_key, parse_int_strict)
from cellfold.operators.locate import SHEET, pos_col, pos_key, pos_row
from cellfold.operators.regions import list_drop_index, merged_height_by_row
from cellfold.plans.issues import issue_rows, union_issues
from cellfold.plans.reading import Program, ProgramResult, mark_profile, own_profile, run_program
from cellfold.sources.bronze import Corpus
from cellfold.sources.grids import FORM_LABELS, FORM_SHEET, FORM_VALUE_OFFSET

# field -> how its value cells are parsed and reduced
#   scalar_int_expr: arithmetic text (F-05), scalar_int: strict int (F-06),
#   scalar_text: text, quarters: blank->0 ints (F-07), pct: fraction text, list: texts
FORM_FIELDS = {
    "total": "scalar_expr", "outdated": "scalar_int", "last_year": "scalar_text",
    "planned": "quarters", "reviewed": "quarters", "carried": "quarters",
    "pct": "pct", "element": "list",
}
INT_MAX = 2147483647

OUTPUT_COLUMNS = (["workbook", "Document_Id", "Year", "Op_Procedures", "Last_Updated_OP_Year",
                   "Number_Of_outdatedOPs"]
                  + [f"Planned_for_Review_Q{k}" for k in range(1, 5)]
                  + [f"Carried_Forward_Procedure_Q{k}" for k in range(1, 5)]
                  + [f"Perc_of_Procedure_Rvd_Vs__Plnd_Q{k}" for k in range(1, 5)])


def resolve_form_sheet(sheets: DataFrame, sheet_name: str = FORM_SHEET) -> DataFrame:
    """P-06 for the form: last sheet whose trimmed lower name matches."""
    return (sheets.filter(F.col("sheet_key") == label_key(sheet_name))
            .groupBy("workbook").agg(F.max("sheet_idx").alias("sheet_idx")))


def label_anchors(hits: DataFrame, merges: DataFrame, planned_seen: bool = False) -> DataFrame:
    """J-05/J-08 + A-02: per (sheet, field) the last label cell (``hits``: sheet, row, col,
    field) that sits on a row where a merged region starts, with that region's height.

    ``planned_seen`` adds the field of that name: the last planned block
    before the last % block (Q-08)."""
    on_merge = hits.join(merged_height_by_row(merges), [*SHEET, "row"])
    if planned_seen:
        pct = (on_merge.filter(F.col("field") == "pct").groupBy(*SHEET)
               .agg(F.max(pos_key()).alias("pct_pos")))
        earlier = (on_merge.filter(F.col("field") == "planned").join(pct, SHEET)
                   .filter(pos_key() < F.col("pct_pos")).drop("pct_pos"))
        on_merge = on_merge.unionByName(earlier.withColumn("field", F.lit("planned_seen")))
    best = (on_merge.groupBy(*SHEET, "field")
            .agg(F.max(F.struct(pos_key().alias("p"), F.col("height"))).alias("b")))
    return best.select(*SHEET, "field", pos_row(F.col("b.p")).alias("row"),
                       pos_col(F.col("b.p")).alias("col"), F.col("b.height").alias("height"),
                       F.col("b.p").alias("pos"))


def field_values(reads: DataFrame) -> DataFrame:
    """Every member row of each anchored block, parsed per field (``reads``: one row per
    target; part = field, n1 = height, n2 = member)."""
    txt = jtrim(formatted_text("text"))
    fld = F.col("part")
    v_int = (F.when(fld == "total", arith_text_eval(txt))
             .when(fld == "outdated", parse_int_strict(txt))
             .when(fld.isin("planned", "planned_seen", "reviewed", "carried"), blank_to_zero_int("text")))
    return reads.select(*SHEET, fld.alias("field"), F.col("n1").alias("height"), F.col("n2").alias("i"),
                        txt.alias("v_text"), v_int.alias("v_int"), string_read().alias("v_str"))


class FormProgram(Program):
    """T-02 over the form sheets of the corpus's workbooks."""

    SCHEMA = ("workbook string, Document_Id int, Year int, Op_Procedures int, Last_Updated_OP_Year string, "
              "Number_Of_outdatedOPs int, " + ", ".join(f"{c} int" for c in OUTPUT_COLUMNS[6:14]) + ", "
              + ", ".join(f"{c} double" for c in OUTPUT_COLUMNS[14:]))
    columns = ("ctype", "str", "text")

    def __init__(self, corpus: Corpus, sheet_name: str = FORM_SHEET,
                 labels: dict[str, str] = FORM_LABELS, dc: int = FORM_VALUE_OFFSET,
                 compat: bool = False, include_parsed: bool = False,
                 document_id: int = 1, year: int = 2018):
        super().__init__(corpus)
        self.keys = {f: label_key(t) for f, t in labels.items()}
        self.form, self.dc, self.compat = resolve_form_sheet(corpus.sheets, sheet_name), dc, compat
        self.include_parsed, self.document_id, self.year = include_parsed, document_id, year

    def labels(self) -> list[str]:
        return list(self.keys.values())

    def wanted(self) -> Column:
        return F.col("text_key").isin(self.labels())

    def marks(self) -> dict[str, Column]:
        name = reduce(lambda c, x: c.when(F.col("text_key") == x[1], F.lit(x[0])), self.keys.items(), F)
        # the label cells of one row; few, and at most its columns
        return {"hits": F.nullif(F.collect_list(F.when(name.isNotNull(), F.struct(
            F.col("col"), name.alias("field")))), F.array().cast("array<struct<col:int,field:string>>"))}

    def find_anchors(self, profile: DataFrame) -> DataFrame:
        hits = (profile.join(self.form.select(*SHEET), SHEET, "left_semi")
                .select(*SHEET, "row", F.inline("hits")))
        return label_anchors(hits, self.corpus.merges, planned_seen=self.compat)

    def targets(self, profile: DataFrame) -> DataFrame:
        self.anchors = a = self.find_anchors(profile)
        return (a.select(*SHEET, "field", "height", "col", F.col("row").alias("top"),
                         F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("i"))
                .select(F.col("field").alias("part"), F.col("height").alias("n1"), F.col("i").alias("n2"), *SHEET,
                        (F.col("top") + F.col("i")).alias("row"), (F.col("col") + self.dc).alias("col")))

    def finish(self, reads: DataFrame) -> ProgramResult:
        return record_of_values(self, field_values(reads))


def record_of_values(program: FormProgram, vals: DataFrame) -> ProgramResult:
    """The record of each form sheet, folded from its fields' values, and the issues."""
    corpus, form, anchors = program.corpus, program.form, program.anchors
    compat, include_parsed = program.compat, program.include_parsed
    document_id, year = program.document_id, program.year
    fld, i, last = F.col("field"), F.col("i"), F.col("i") == F.col("height") - 1

    def pick(name, col, cond=None):
        c = (fld == name) & (last if cond is None else cond)
        return F.max(F.when(c, F.col(col)))

    aggs = [pick("total", "v_int").alias("total"),
            pick("outdated", "v_int").alias("outdated"),
            pick("last_year", "v_text").alias("last_year"),
            F.max(F.when(fld == "planned", 1)).alias("has_planned"),
            F.max(F.when(fld == "pct", 1)).alias("has_pct"),
            F.max(F.when(fld == "planned", F.col("height"))).alias("planned_h")]
    for q in range(4):
        for f in ("planned", "reviewed", "carried", *(["planned_seen"] if compat else [])):
            aggs.append(pick(f, "v_int", i == q).alias(f"{f}{q + 1}"))
        aggs.append(pick("pct", "v_str", i == q).alias(f"pct_text{q + 1}"))
    if include_parsed:
        aggs.append(F.array_sort(F.collect_list(
            F.when(fld == "element", F.struct(i.alias("o"), F.col("v_text").alias("v")))))
            .alias("_elements"))
    rec = vals.groupBy(*SHEET).agg(*aggs)

    r = form.join(rec, SHEET, "left")
    # compat (Q-08): the % block only knows the planned block read before it
    seen = "planned_seen" if compat else "planned"
    planned = [F.coalesce(F.col(f"{seen}{q}"), F.lit(0)) for q in range(1, 5)]
    all_zero = (planned[0] == 0) & (planned[1] == 0) & (planned[2] == 0) & (planned[3] == 0)
    # an absent % label is unknown (NULL); NaN means that nothing was planned
    absent = nan() if compat else F.lit(None).cast("double")
    pct = [F.when(F.col("has_pct").isNull(), absent)
           .otherwise(guarded_percent(all_zero, F.col(f"pct_text{q}"))) for q in range(1, 5)]

    def dflt(c, sentinel):
        return F.coalesce(c, F.lit(sentinel)) if compat else c

    cols = [F.col("workbook"), F.lit(document_id).cast("int").alias("Document_Id"),
            F.lit(year).cast("int").alias("Year"),
            dflt(F.col("total"), INT_MAX).cast("int").alias("Op_Procedures"),
            dflt(F.col("last_year"), "").alias("Last_Updated_OP_Year"),
            dflt(F.col("outdated"), INT_MAX).cast("int").alias("Number_Of_outdatedOPs")]
    cols += [dflt(F.col(f"planned{q}"), 0).cast("int").alias(f"Planned_for_Review_Q{q}")
             for q in range(1, 5)]
    cols += [dflt(F.col(f"carried{q}"), 0).cast("int").alias(f"Carried_Forward_Procedure_Q{q}")
             for q in range(1, 5)]
    cols += [pct[q - 1].alias(f"Perc_of_Procedure_Rvd_Vs__Plnd_Q{q}") for q in range(1, 5)]
    if include_parsed:
        cols += [F.col(f"reviewed{q}").cast("int").alias(f"Procedures_Reviewed_Q{q}")
                 for q in range(1, 5)]
        cols.append(list_drop_index(F.transform("_elements", lambda x: x["v"]), 2)
                    .alias("Element"))
    table = r.select(*cols)

    op = "form_record"
    wbs = corpus.sheets.select("workbook").distinct()
    quarter_fields = ["planned", "reviewed", "carried", "pct"]
    issues = [
        issue_rows(wbs.join(form, "workbook", "left_anti"), op, "form sheet not found",
                   sheet_idx=F.lit(None)),
        issue_rows(vals.filter(F.col("field").isin("total", "outdated", "planned", "reviewed",
                                                   "carried") & F.col("v_int").isNull()), op,
                   F.concat(F.lit("not an integer in "), F.col("field"), F.lit(" row "),
                            F.col("i").cast("string"), F.lit(": '"), F.col("v_text"), F.lit("'"))),
        issue_rows(anchors.filter(F.col("field").isin(quarter_fields) & (F.col("height") < 4)),
                   op, F.concat(F.lit("quarter block shorter than 4 rows: "), F.col("field"))),
        issue_rows(r.filter(~all_zero & F.col("has_pct").isNotNull() & F.exists(
            F.array(*[text_percent(F.col(f"pct_text{q}")) for q in range(1, 5)]), F.isnan)),
            op, "percent text not a decimal"),
    ]
    return ProgramResult(table, union_issues(issues),
                         {"form": form, "anchors": anchors, "values": vals, "record": r})


def form_anchors(corpus: Corpus) -> DataFrame:
    """The label anchors of the corpus's form sheets: sheet, field, row, col, height, pos."""
    p = FormProgram(corpus)
    return p.find_anchors(own_profile(mark_profile(corpus, [p]), p))


def form_record(corpus: Corpus, sheet_name: str = FORM_SHEET,
                labels: dict[str, str] = FORM_LABELS, dc: int = FORM_VALUE_OFFSET,
                compat: bool = False, include_parsed: bool = False,
                document_id: int = 1, year: int = 2018) -> ProgramResult:
    return run_program(FormProgram(corpus, sheet_name, labels, dc, compat, include_parsed,
                                   document_id, year))
