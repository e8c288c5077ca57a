"""Command line: (kind, path) pairs in, ORC tables out."""

from cellfold.__main__ import main
from cellfold.sources.grids import FORM_SHEET
from tests.books import book_bytes, metric_sheet
from tests.test_form import BASE, form_sheet


def test_cli_pairs_and_job_file(spark, tmp_path):
    a = tmp_path / "a.xlsx"
    b = tmp_path / "b.xlsx"
    a.write_bytes(book_bytes({"Kikeh": metric_sheet([170] + [0] * 11, [158] + [0] * 11)}))
    b.write_bytes(book_bytes({FORM_SHEET: form_sheet(BASE)}))
    out = tmp_path / "out"
    main(["emy", str(a), "adequacy", str(b), "--out", str(out)])
    oil = spark.read.orc(str(out / "equipment_efficiency_oil")).collect()
    assert [(r["Platform_Name"], r["Month"], r["Result"]) for r in oil] == [("Kikeh", "Jan", 51.83)]
    (form,) = spark.read.orc(str(out / "adequacy_ops_procedure")).collect()
    assert form["Op_Procedures"] == 55
    # the same jobs from a job-list file append a second time (re-run semantics)
    jobs = tmp_path / "jobs.txt"
    jobs.write_text(f"emy {a}\nadequacy {b}\n")
    main(["--jobs", str(jobs), "--out", str(out)])
    assert spark.read.orc(str(out / "equipment_efficiency_oil")).count() == 2
    assert spark.read.orc(str(out / "adequacy_ops_procedure")).count() == 2


def test_cli_path_forms_and_missing_files(spark, tmp_path, monkeypatch):
    """Relative paths, file:/// URIs and plain paths all run; a missing file is an issue row."""
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.xlsx").write_bytes(
            book_bytes({"Kikeh": metric_sheet([170] + [0] * 11, [158] + [0] * 11)}))
    import os
    relative = os.path.relpath(tmp_path / "a.xlsx")
    out = tmp_path / "out"
    main(["emy", relative, "emy", f"file:///{str(tmp_path)[1:]}/b.xlsx", "emy", str(tmp_path / "c.xlsx"),
          "emy", str(tmp_path / "gone.xlsx"), "emy", "nosuchfs://x/y.xlsx", "--out", str(out)])
    assert spark.read.orc(str(out / "equipment_efficiency_oil")).count() == 3
    gone = spark.read.orc(str(out / "issues")).filter("operator = 'job_source'").collect()
    assert sorted(r["reason"].split("/")[-1] for r in gone) == ["gone.xlsx'", "y.xlsx'"]


def test_cli_with_missing_files_only(spark, tmp_path):
    out = tmp_path / "out"
    main(["emy", str(tmp_path / "gone.xlsx"), "--out", str(out)])
    assert spark.read.orc(str(out / "issues")).count() == 1


def test_cli_decodes_each_file_once(spark, tmp_path, monkeypatch):
    from cellfold.sources import xlsx
    log = tmp_path / "decoded.log"
    real = xlsx.decode_workbook

    def counted(name, content):
        with log.open("a") as f:
            f.write(name + "\n")
        return real(name, content)

    def batches(it, schema=xlsx._ARROW_SCHEMA):
        for b in it:
            for name, content in zip(b.column("workbook"), b.column("content")):
                yield xlsx._to_batch(list(counted(name.as_py(), content.as_py())))

    monkeypatch.setattr(xlsx, "_decode_batches", batches)
    (tmp_path / "a.xlsx").write_bytes(book_bytes({"Kikeh": metric_sheet([170] + [0] * 11, [158] + [0] * 11)}))
    main(["emy", str(tmp_path / "a.xlsx"), "--out", str(tmp_path / "out")])
    assert len(log.read_text().splitlines()) == 1
