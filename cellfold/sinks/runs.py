"""Appends that survive a retry: one part per run, and a ledger of the runs that are whole.

A plain append (``sinks.orc``) adds its rows again when a failed run is
repeated. Here every run writes its rows to a part of its own in each table
(``run_id=...``), replacing what an earlier attempt left there, and when all
tables are written one row in the ledger commits the run. A committed run is
never written again; rows of a run without that row are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run_id"
_LEDGER = "run_id string, targets array<string>"


def write_part(df: DataFrame, target: str, name: str, value: str, as_table: bool = False) -> None:
    """Replace the part ``name=value`` of a table; no rows leave an empty part."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", value):
        raise ValueError(f"a part's value must be letters, digits, _ or -: {value!r}")
    if not as_table:
        df.write.mode("overwrite").orc(f"{target}/{name}={value}")
        return
    spark = df.sparkSession
    if not spark.catalog.tableExists(target):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {target} ({ddl}, {name} string) USING orc PARTITIONED BY ({name})")
    columns = [c for c in spark.table(target).columns if c != name]
    missing = set(df.columns) ^ set(columns)
    if missing:
        raise ValueError(f"columns of {target} and of the rows differ: {sorted(missing)}")
    df.createOrReplaceTempView("part_rows")
    named = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({name} = '{value}') SELECT {named} FROM part_rows")


def ledger_rows(spark: SparkSession, ledger: str) -> DataFrame:
    """The committed runs; the ledger need not exist yet."""
    spark.createDataFrame([], _LEDGER).write.mode("append").parquet(ledger)
    return spark.read.schema(_LEDGER).parquet(ledger)


def append_run(outputs: dict[str, DataFrame], run_id: str, ledger: str, as_table: bool = False) -> bool:
    """Append the run's rows to every target. False if the run was committed before:
    then nothing is computed or written."""
    spark = next(iter(outputs.values())).sparkSession
    if ledger_rows(spark, ledger).filter(F.col(RUN) == run_id).limit(1).count():
        return False
    for target, df in outputs.items():
        write_part(df, target, RUN, run_id, as_table)
    spark.createDataFrame([(run_id, sorted(outputs))], _LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return True


def read_committed(spark: SparkSession, target: str, ledger: str, as_table: bool = False) -> DataFrame:
    """Rows of a target from committed runs, with ``run_id``."""
    rows = spark.table(target) if as_table else spark.read.orc(target)
    runs = ledger_rows(spark, ledger).filter(F.array_contains("targets", target)).select(RUN).distinct()
    return rows.withColumn(RUN, F.col(RUN).cast("string")).join(runs, RUN, "left_semi")
