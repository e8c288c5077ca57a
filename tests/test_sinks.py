"""Sinks: managed tables, one plan for many tables, and appends that survive a retry."""

import pytest
from pyspark.sql import functions as F

from cellfold.__main__ import main
from cellfold.sinks import runs
from cellfold.sinks.orc import append_orc, append_routed
from tests.books import book_bytes, metric_sheet


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_append_to_a_managed_table(spark, database):
    """Created when absent, matched by name, appended again by a re-run; a missing column is refused."""
    target = f"{database}.t"
    append_orc(spark.createDataFrame([(1, "a")], "n int, s string"), target, as_table=True)
    append_orc(spark.createDataFrame([("b", 2)], "s string, n int"), target, as_table=True)
    assert rows(spark.table(target).select("n", "s")) == [(1, "a"), (2, "b")]
    assert spark.catalog.getTable(target).tableType == "MANAGED"
    with pytest.raises(Exception):
        append_orc(spark.createDataFrame([(3,)], "n int"), target, as_table=True)
    assert spark.table(target).count() == 2


def test_cli_writes_managed_tables(spark, tmp_path, database):
    a = tmp_path / "a.xlsx"
    a.write_bytes(book_bytes({"Kikeh": metric_sheet([170] + [0] * 11, [158] + [0] * 11)}))
    for _ in range(2):
        main(["emy", str(a), "--out-db", database])
    got = spark.table(f"{database}.equipment_efficiency_oil")
    assert rows(got.select("Platform_Name", "Month", "Result")) == [("Kikeh", "Jan", 51.83)] * 2
    assert spark.table(f"{database}.equipment_efficiency_gas").count() == 0


def test_routed_append_runs_the_plan_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def product(n):
        seen.add(1)
        return "gas" if n % 3 == 0 else "oil"

    df = spark.range(12).withColumn("product", product.asNondeterministic()("id"))
    append_routed(df, {p: str(tmp_path / p) for p in ("oil", "gas")})
    assert seen.value == 12
    assert spark.read.orc(str(tmp_path / "gas")).count() == 4 and spark.read.orc(str(tmp_path / "oil")).count() == 8


@pytest.mark.parametrize("as_table", [False, True])
def test_a_repeated_run_adds_nothing_and_a_failed_one_is_replaced(spark, tmp_path, database, as_table):
    at = (lambda n: f"{database}.{n}") if as_table else (lambda n: str(tmp_path / n))
    ledger, one, two = str(tmp_path / "ledger"), at("one"), at("two")
    first, second = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([(2,)], "n int")

    @F.udf("int")
    def fail(n):
        raise RuntimeError("executor lost")

    with pytest.raises(Exception):  # between two tables
        runs.append_run({one: first, two: second.select(fail("n").alias("n"))}, "r1", ledger, as_table)
    assert runs.read_committed(spark, one, ledger, as_table).count() == 0
    more = first.unionByName(spark.createDataFrame([(5, None)], "n int, s string"))
    assert runs.append_run({one: more, two: second}, "r1", ledger, as_table)  # the retry has other rows
    assert rows(runs.read_committed(spark, one, ledger, as_table).select("n", "s")) == [(1, "x"), (5, None)]
    assert not runs.append_run({one: first, two: second}, "r1", ledger, as_table)
    assert runs.read_committed(spark, two, ledger, as_table).count() == 1
    assert runs.append_run({one: first.limit(0), two: second.select("n")}, "r2", ledger, as_table)
    assert runs.append_run({one: first.select("s", "n"), two: second}, "r3", ledger, as_table)
    assert runs.read_committed(spark, one, ledger, as_table).count() == 3
    assert rows(runs.read_committed(spark, two, ledger, as_table).select("n", "run_id")) == [
        (2, "r1"), (2, "r2"), (2, "r3")]


def test_a_part_without_rows_replaces_what_was_there(spark, tmp_path):
    """An epoch that is repeated without rows leaves none behind."""
    out, df = str(tmp_path / "out"), spark.createDataFrame([(1,)], "n int")
    for epoch in (0, 1):
        runs.write_part(df, out, "epoch", str(epoch))
    runs.write_part(df.limit(0), out, "epoch", "0")
    assert rows(spark.read.schema("n int, epoch int").orc(out)) == [(1, 1)]
    with pytest.raises(ValueError):
        runs.write_part(df, out, "epoch", "../x")


def test_cli_run_id_and_listed_twice(spark, tmp_path):
    a, out = tmp_path / "a.xlsx", tmp_path / "out"
    a.write_bytes(book_bytes({"Kikeh": metric_sheet([170] + [0] * 11, [158] + [0] * 11)}))
    for run in ("r1", "r1", "r2"):
        main(["emy", str(a), "emy", str(a), "--out", str(out), "--run-id", run])
    got = runs.read_committed(spark, f"{out}/equipment_efficiency_oil", f"{out}/run_ledger")
    assert rows(got.select("run_id", "Month")) == [("r1", "Jan"), ("r2", "Jan")]
    twice = tmp_path / "twice"
    main(["emy", str(a), "emy", str(a), "emy", str(a), "--out", str(twice), "--compat"])
    # each of the seven tabs falls back to the first sheet in compat mode, for each listing
    assert spark.read.orc(str(twice / "equipment_efficiency_oil")).count() == 7 * 3
