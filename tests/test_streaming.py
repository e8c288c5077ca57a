"""Landing-folder stream: new workbooks are processed once; a second run
with no new files adds nothing."""

from cellfold.streaming.landing import start
from tests.books import metric_sheet, book_bytes


def test_landing_folder_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "emy").mkdir(parents=True)
    (landing / "pdf").mkdir(parents=True)
    sheet = metric_sheet([170] + [0] * 11, [158] + [0] * 11)
    (landing / "emy" / "a.xlsx").write_bytes(book_bytes({"Kikeh": sheet}))
    (landing / "pdf" / "b.xlsx").write_bytes(book_bytes({"X": {"cells": {(0, 0): "x"}}}))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    q = start(spark, str(landing), out, ckpt)
    q.awaitTermination(120)
    eff = spark.read.orc(f"{out}/efficiency").collect()
    assert [(r["Platform_Name"], r["Month"], r["Result"]) for r in eff] == [("Kikeh", "Jan", 51.83)]
    issues = [r["reason"] for r in spark.read.orc(f"{out}/issues").collect()]
    assert "unknown job kind: 'pdf'" in issues

    # nothing new: a second run does not reprocess the files
    q2 = start(spark, str(landing), out, ckpt)
    q2.awaitTermination(120)
    assert spark.read.orc(f"{out}/efficiency").count() == 1
