"""Command line: run a list of (kind, path) jobs end to end.

    python -m cellfold emy /data/a.xlsx aims /data/b.xlsx --out /warehouse/out
    python -m cellfold --jobs jobs.txt --out-db analytics --compat

Arguments come in pairs like the source job's command line, or one
'kind path' per line in a job-list file (read with Spark). All listed
workbooks are decoded in one scan into bronze (written once, under
``--bronze`` or the session's checkpoint folder), every program runs once
over the workbooks of its kind, and each output is appended as ORC: to
tables in ``--out-db`` or to folders under ``--out``.
"""

from __future__ import annotations

import argparse
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellfold.plans.dispatch import DispatchResult, normalise_kind, parse_job_args, run_jobs
from cellfold.plans.issues import issue_rows
from cellfold.session import SESSION_DEFAULTS, scratch_path, stored
from cellfold.sinks.orc import (EFFICIENCY_TABLES, FORM_TABLE, INSPECTION_TABLE, append_orc,
                                append_routed, product_of)
from cellfold.sinks.runs import append_run
from cellfold.sources.bronze import materialize
from cellfold.sources.xlsx import DECODED_SCHEMA, decode, to_corpus


def located(spark: SparkSession, jobs):
    """The job list with each path as the file source reports it (``workbook``) and
    whether it exists. Reads the job list only: one path per file."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for r in jobs.select("path").distinct().collect():
        try:
            p = jvm.org.apache.hadoop.fs.Path(r["path"])
            fs = p.getFileSystem(conf)
            rows.append((r["path"], fs.makeQualified(p).toString(), fs.isFile(p)))
        except Exception:  # no such file system, an empty or malformed path
            rows.append((r["path"], r["path"], False))
    found = spark.createDataFrame(rows, "own_path string, workbook string, found boolean")
    return jobs.join(found, jobs["path"].eqNullSafe(found["own_path"])).drop("own_path"), [
        w for _, w, ok in rows if ok]


def as_often_as_listed(res: DispatchResult, jobs) -> DispatchResult:
    """The outputs with the rows of a job repeated for every time that it is listed."""
    listed = jobs.groupBy("workbook", normalise_kind("kind").alias("kind")).agg(F.count("*").alias("times"))

    def repeat(df, kinds, on=("workbook",)):
        times = listed.filter(F.col("kind").isin(kinds)).withColumn("product", product_of(F.col("kind")))
        return (df.join(times.select(*on, "times"), list(on))
                .withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times"))

    return replace(res, efficiency=repeat(res.efficiency, ["emy", "emy2"], ("workbook", "product")),
                   form=repeat(res.form, ["adequacy"]), inspection=repeat(res.inspection, ["aims"]))


def run(spark: SparkSession, jobs, out_dir: str | None = None, out_db: str | None = None,
        bronze: str | None = None, compat: bool = False, run_id: str | None = None,
        ledger: str | None = None) -> dict:
    """Decode the listed workbooks once, run every job, append the outputs.

    A job whose file is not there becomes an issue row; the others run. A job
    listed twice runs once; with ``compat`` its rows are appended as often as it
    is listed. With ``run_id`` the outputs go to the run's own parts and the
    ledger (``cellfold.sinks.runs``): a repeated run adds nothing.
    """
    jobs, paths = located(spark, jobs)
    missing = issue_rows(jobs.filter("not found"), "job_source",
                         F.concat(F.lit("no such file: '"), F.coalesce("path", F.lit("")), F.lit("'")),
                         sheet_idx=F.lit(None))
    path = bronze or scratch_path(spark, f"bronze_run_{uuid.uuid4().hex}")
    if paths:
        files = (spark.read.format("binaryFile").load(paths)
                 .select(F.col("path").alias("workbook"), "content"))
    else:
        files = spark.createDataFrame([], "workbook string, content binary")
    # the decoded stream is written once; sheets, cells, merges and errors are read from it
    decode(files).write.mode("overwrite").partitionBy("kind").parquet(f"{path}/decoded")
    corpus, errors = to_corpus(spark.read.schema(DECODED_SCHEMA).parquet(f"{path}/decoded"))
    corpus = materialize(corpus, path)
    errors = errors.unionByName(missing)
    j = jobs.filter("found").select("kind", "workbook").distinct()
    res = run_jobs(j, corpus, compat=compat)
    if compat:
        res = as_often_as_listed(res, jobs.filter("found"))
    as_table = out_db is not None

    def target(name):
        return f"{out_db}.{name}" if as_table else f"{out_dir}/{name}"
    all_issues = res.issues.unionByName(errors)
    if run_id:
        efficiency = stored(res.efficiency, "routed")
        outputs = {target(t): efficiency.filter(F.col("product") == p).drop("product")
                   for p, t in EFFICIENCY_TABLES.items()}
        outputs |= {target(FORM_TABLE): res.form, target(INSPECTION_TABLE): res.inspection,
                    target("issues"): all_issues}
        append_run(outputs, run_id, ledger or target("run_ledger"), as_table)
    else:
        append_routed(res.efficiency, {p: target(t) for p, t in EFFICIENCY_TABLES.items()}, as_table)
        append_orc(res.form, target(FORM_TABLE), as_table)
        append_orc(res.inspection, target(INSPECTION_TABLE), as_table)
        append_orc(all_issues, target("issues"), as_table)
    return {"efficiency": res.efficiency, "form": res.form, "inspection": res.inspection,
            "issues": res.issues.unionByName(errors)}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="cellfold")
    ap.add_argument("pairs", nargs="*", help="kind path [kind path ...]")
    ap.add_argument("--jobs", help="text file with one 'kind path' per line")
    ap.add_argument("--out", help="output folder (ORC per table)")
    ap.add_argument("--out-db", help="database for ORC tables (saveAsTable, append)")
    ap.add_argument("--bronze", help="where to write the decoded bronze tables")
    ap.add_argument("--run-id", help="name of the run: a repeated run adds nothing")
    ap.add_argument("--ledger", help="folder of the run ledger (default: beside --out)")
    ap.add_argument("--compat", action="store_true", help="reproduce source-system quirks")
    a = ap.parse_args(argv)
    if not (a.out or a.out_db):
        ap.error("one of --out / --out-db is required")
    if a.run_id and a.out_db and not a.ledger:
        ap.error("--run-id with --out-db needs --ledger")
    if len(a.pairs) % 2:
        ap.error("arguments come in (kind, path) pairs")
    builder = SparkSession.builder.appName("cellfold")
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if a.jobs:
        jobs = parse_job_args(spark.read.text(a.jobs))
    else:
        pairs = [(a.pairs[i], a.pairs[i + 1]) for i in range(0, len(a.pairs), 2)]
        jobs = spark.createDataFrame(pairs, "kind string, path string")
    run(spark, jobs, out_dir=a.out, out_db=a.out_db, bronze=a.bronze, compat=a.compat,
        run_id=a.run_id, ledger=a.ledger)


if __name__ == "__main__":
    main()
