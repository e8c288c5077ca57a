"""Scale invariance: the same answers with 1 and 8 shuffle partitions, and
N copies of a workbook give N times the rows (one plan for the corpus)."""

from cellfold.plans.efficiency import equipment_efficiency
from cellfold.plans.form import form_record
from tests.books import corpus_of, metric_sheet
from tests.test_form import BASE, form_sheet


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_shuffle_partitions_do_not_change_results(spark):
    books = {f"wb{i}": {"Kikeh": metric_sheet([i, 1, 2] + [0] * 9, [1, i, 0] + [0] * 9)}
             for i in range(6)}
    corpus, _ = corpus_of(spark, books)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = _rows(equipment_efficiency(corpus, ["Kikeh"]).table)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        b = _rows(equipment_efficiency(corpus, ["Kikeh"]).table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b and len(a) > 0


def test_copies_scale_rows(spark):
    one, _ = corpus_of(spark, {"wb0": {"Form - Document_Q1 2018": form_sheet(BASE)}})
    many, _ = corpus_of(spark, {f"wb{i}": {"Form - Document_Q1 2018": form_sheet(BASE)}
                                for i in range(12)})
    r1 = [tuple(r)[1:] for r in form_record(one).table.collect()]
    rn = [tuple(r)[1:] for r in form_record(many).table.collect()]
    assert len(rn) == 12 and all(r == r1[0] for r in rn)
