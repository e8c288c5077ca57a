"""Incremental ingestion of a landing folder of workbooks.

The batch job takes a list of (kind, path) pairs; here the same job runs as a
Structured Streaming query over a folder where workbooks arrive, one
sub-folder per job kind (``<landing>/<kind>/<file>.xlsx``). Each micro-batch
decodes only the new files (``binaryFile`` file source, progress kept in the
stream checkpoint), runs the programs over them, and writes every output
to a part of its own per ``epoch``, so a retried micro-batch replaces its own
output instead of appending it twice, also where the retry has no rows.

There is no event time, watermark or cross-batch state: every workbook is
self-contained, so each micro-batch is an independent batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellfold.plans.dispatch import run_jobs
from cellfold.sinks.runs import write_part
from cellfold.sources.xlsx import decode, to_corpus


# The binaryFile source's fixed schema (a streaming source needs it declared).
BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _kind_of(path_col: str = "workbook") -> F.Column:
    """Job kind = name of the folder holding the file."""
    return F.element_at(F.split(F.col(path_col), "/"), -2)


def _write_epoch(df: DataFrame, path: str, epoch_id: int) -> None:
    """The epoch's part of an output; a repeated epoch replaces it, also where it now has no rows."""
    write_part(df, path, "epoch", str(epoch_id))


def process_batch(batch: DataFrame, epoch_id: int, out_dir: str,
                  tabs_by_kind: dict[str, list[str]] | None = None) -> None:
    """One micro-batch: decode the new files, run their jobs, write outputs."""
    files = batch.select(F.col("path").alias("workbook"), "content")
    decoded = decode(files).persist()
    try:
        corpus, errors = to_corpus(decoded)
        jobs = corpus.sheets.select("workbook").distinct().withColumn("kind", _kind_of())
        res = run_jobs(jobs, corpus, tabs_by_kind)
        _write_epoch(res.efficiency, f"{out_dir}/efficiency", epoch_id)
        _write_epoch(res.form, f"{out_dir}/form", epoch_id)
        _write_epoch(res.inspection, f"{out_dir}/inspection", epoch_id)
        _write_epoch(res.issues.unionByName(errors), f"{out_dir}/issues", epoch_id)
    finally:
        decoded.unpersist()


def start(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_location: str,
          tabs_by_kind: dict[str, list[str]] | None = None, available_now: bool = True,
          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing-folder job. ``available_now`` processes what is there
    and stops (scheduled runs); otherwise it keeps polling."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, eid: process_batch(df, eid, out_dir, tabs_by_kind))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
