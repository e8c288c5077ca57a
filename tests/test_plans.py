"""Plan regression checks: filters reach the Parquet scan, scans read only the columns a
step needs, and cells stay in the buckets they are stored in."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cellfold.operators.locate import (column_window, find_header_anchor, find_labels_indexed,
                                       read_cells, read_targets)
from cellfold.plans import catalog
from cellfold.plans.dispatch import run_jobs
from cellfold.plans.efficiency import EfficiencyProgram, equipment_efficiency
from cellfold.plans.form import FormProgram, form_record
from cellfold.plans.inspection import InspectionProgram, inspection_program
from cellfold.plans.reading import index_profile, label_profile, mark_profile, own_profile
from cellfold.session import stored
from cellfold.sources.bronze import (CELLS_SCHEMA, MERGES_SCHEMA, Corpus, finish_cells, materialize,
                                     numeric_rows, read_corpus, with_sheet_key, write_corpus)

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _cells_scans(plan: str):
    """(pushed filters, read schema) of every scan of the bronze cells (the
    only bronze table with both row and col columns)."""
    out = []
    for line in plan.splitlines():
        m = re.search(r"FileScan parquet \S*\[([^\]]*)\]", line)
        if m and re.search(r"\brow#", m.group(1)) and re.search(r"\bcol#", m.group(1)):
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            out.append((pushed.group(1) if pushed else "", schema.group(1) if schema else ""))
    return out


def _moved_scans(df, table: str = "cellfold_") -> list[str]:
    """Scans of stored cells whose rows go into an exchange as they are: between the two
    only filters, projections and sorts."""
    found = []

    def name(node):
        return node.nodeName()

    def children(node):
        kids = [node.children().apply(i) for i in range(node.children().size())]
        if name(node).startswith("AdaptiveSparkPlan"):
            kids = [node.initialPlan()]
        return kids

    def below(node):
        if "scan" in name(node).lower() and table in node.toString():
            found.append(node.toString().splitlines()[0][:200])
        elif re.match(r"Project|Filter|Sort$|ColumnarToRow|WholeStageCodegen|InputAdapter", name(node)):
            for k in children(node):
                below(k)

    def walk(node):
        if "Exchange" in name(node):
            for k in children(node):
                below(k)
        for k in children(node):
            walk(k)

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def _programs(spark):
    g1, g2, g3 = catalog.g1(spark, SF), catalog.g2(spark, SF), catalog.g3(spark, SF)
    return [(g1, EfficiencyProgram(g1, catalog.g1_tabs(spark, SF))), (g2, FormProgram(g2)),
            (g3, InspectionProgram(g3))]


def test_cells_are_never_moved(spark, no_broadcast):
    for corpus, program in _programs(spark):
        profile = label_profile(corpus.cells, {0: program})
        assert _cells_scans(_plan(profile)) and "Exchange" not in _plan(profile)
        targets = program.targets(own_profile(profile, program))
        reads = read_cells(corpus.cells, targets, list(program.columns))
        plan = _plan(reads)
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert "BroadcastHashJoin" not in plan and not _moved_scans(reads)
    g1, g3 = catalog.g1(spark, SF), catalog.g3(spark, SF)
    a = find_header_anchor(g1.cells, "jan").withColumnRenamed("col", "start")
    assert not _moved_scans(column_window(g1.cells, a))
    assert not _moved_scans(read_targets(g1.cells, a.withColumnRenamed("start", "col")))
    # the bitmaps lie in the same buckets, and are made of the cells where these lie
    program = _programs(spark)[2][1]
    pairs = program.find_pairs(own_profile(mark_profile(g3, [program]), program))
    counts = program.week_counts(pairs)
    assert not _moved_scans(counts) and "Bucketed: true" in _plan(counts)
    assert "Exchange" not in _plan(numeric_rows(g3.cells))


def test_the_check_sees_cells_that_move(spark, no_broadcast):
    """Without buckets the same read shuffles the cells, and the check says so."""
    corpus, program = _programs(spark)[0]
    profile = own_profile(label_profile(corpus.cells, {0: program}), program)
    moved = corpus.cells.repartition(3).select(*[f.name for f in CELLS_SCHEMA.fields])
    reads = read_cells(moved, program.targets(profile), list(program.columns))
    assert _moved_scans(reads)


class _Counted:
    """Counts the uses of a corpus's cells."""

    def __init__(self, monkeypatch):
        from cellfold.plans import reading
        self.profiles = self.reads = 0
        label, read = reading.label_profile, reading.read_cells

        def one(cells, programs):
            self.profiles += 1
            return label(cells, programs)

        def two(cells, targets, columns):
            self.reads += 1
            return read(cells, targets, columns)
        monkeypatch.setattr(reading, "label_profile", one)
        monkeypatch.setattr(reading, "read_cells", two)


def test_dispatch_reads_the_cells_twice(spark, monkeypatch):
    """All programs of a run share two scans of cells; what they return scans none."""
    corpus, n = catalog.everything(spark, SF), _Counted(monkeypatch)
    kind = F.element_at(F.array(*map(F.lit, ("emy", "adequacy", "aims"))), F.when(
        F.col("workbook").startswith("customer"), 2).when(F.col("workbook").startswith("schedule"), 3).otherwise(1))
    jobs = corpus.sheets.select("workbook").distinct().withColumn("kind", kind)
    res = run_jobs(jobs, corpus, {"emy": catalog.g1_tabs(spark, SF), "emy2": ["x"]})
    assert (n.profiles, n.reads) == (1, 1)
    for df in (res.efficiency, res.form, res.inspection, res.issues):
        assert df.count() >= 0 and not _cells_scans(_plan(df))


def test_table_and_issues_come_from_one_read(spark, monkeypatch):
    """T-02 and T-03 find their labels in the index: they scan the cells once, not twice."""
    for profiles, run in ((1, lambda: equipment_efficiency(catalog.g1(spark, SF), catalog.g1_tabs(spark, SF))),
                          (0, lambda: form_record(catalog.g2(spark, SF))),
                          (0, lambda: inspection_program(catalog.g3(spark, SF)))):
        n = _Counted(monkeypatch)
        res = run()
        assert (n.profiles, n.reads) == (profiles, 1)
        assert not _cells_scans(_plan(res.table)) and not _cells_scans(_plan(res.issues))
        monkeypatch.undo()


def test_label_index_gives_the_marks_of_a_scan(spark):
    key = lambda df: sorted(str(sorted(r.asDict().items())) for r in df.collect())
    for corpus, program in _programs(spark)[1:]:
        assert key(index_profile(corpus, {0: program})) == key(label_profile(corpus.cells, {0: program}))
        assert "key:bigint" in _plan(index_profile(corpus, {0: program}))


def test_without_label_index_programs_scan(spark):
    g2, g3 = catalog.g2(spark, SF), catalog.g3(spark, SF)
    key = lambda df: sorted(map(str, df.collect()))
    for run, corpus in ((form_record, g2), (inspection_program, g3)):
        assert key(run(corpus).table) == key(run(replace(corpus, labels=None)).table)


def _rows_read(df) -> int:
    """Rows that the scans of an executed plan put out."""
    total = 0

    def walk(node):
        nonlocal total
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if "Scan parquet" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return total


def test_label_search_reads_its_share_of_the_index(spark, tmp_path):
    """Of an index of many pages, the pages of one text are read, however many others there
    are; a text that every sheet has is spread over files."""
    n = 400_000
    rows = spark.range(n).selectExpr(
        "concat('w', id % 50) AS workbook", "0 AS sheet_idx", "cast(id div 50 AS int) AS row", "0 AS col",
        "'string' AS ctype", "cast(null AS double) AS num", "'' AS str", "cast(null AS string) AS formula",
        "CASE WHEN id % 40 = 0 THEN 'Common' WHEN id < 50 THEN ' Rare ' ELSE concat('text ', id) END AS text")
    sheets = rows.select("workbook", "sheet_idx").distinct().withColumn("sheet", F.lit("s"))
    merges = spark.createDataFrame([], MERGES_SCHEMA)
    corpus = materialize(Corpus(with_sheet_key(sheets), finish_cells(rows), merges), str(tmp_path / "b"))
    assert corpus.labels.count() == n
    found = {k: corpus.labelled([k]) for k in ("rare", "common", "absent text")}
    assert {k: df.count() for k, df in found.items()} == {"rare": 48, "common": n // 40, "absent text": 0}
    share = {k: _rows_read(df) / n for k, df in found.items()}
    assert share["rare"] < 0.12 and share["absent text"] < 0.12 and share["common"] < 0.2, share
    print("share of rows read", share)
    # the cells hold every text in every bucket, so a search there reads nearly all of them
    assert _rows_read(corpus.cells.filter(F.col("text_key") == "rare")) > 0.8 * n


def test_keys_that_the_index_leaves_out_are_found_by_a_scan(spark, tmp_path):
    cells = [("w", 0, 0, 0, "numeric", 12.0, "12"), ("w", 0, 1, 0, "string", None, " 12"), ("w", 0, 2, 1, "numeric", 1.5, "1.5"),
             ("w", 0, 3, 0, "numeric", 43101.0, "January 2018"), ("w", 0, 4, 0, "string", None, "January 2018"),
             ("w", 0, 5, 0, "blank", None, None), ("w", 1, 5, 0, "formula", None, "A1+2"),
             ("w", 1, 6, 0, "string", None, "%"), ("w", 1, 7, 0, "string", None, "\u0416"), ("w", 1, 8, 0, "numeric", 1e20, "1E20")]
    rows = spark.createDataFrame(cells, "workbook string, sheet_idx int, row int, col int, ctype string, num double, text string")
    rows = rows.withColumn("str", F.lit(None).cast("string")).withColumn("formula", F.lit(None).cast("string"))
    sheets = spark.createDataFrame([("w", 0, "a"), ("w", 1, "b")], "workbook string, sheet_idx int, sheet string")
    corpus = materialize(Corpus(with_sheet_key(sheets), finish_cells(rows), spark.createDataFrame([], MERGES_SCHEMA)),
                         str(tmp_path / "b"))
    at = lambda *keys: sorted(r["row"] for r in corpus.labelled(list(keys)).collect())
    assert (at("12"), at("1.5"), at("january 2018"), at("a1+2"), at("")) == ([0, 1], [2], [3, 4], [5], [5])
    assert at("12", "january 2018") == [0, 1, 3, 4]
    assert (at("%"), at("\u0436"), at("1e20"), at("no such text")) == ([6], [7], [8], [])
    found = find_labels_indexed(corpus, {"m": "January 2018", "n": "12", "x": "none"}).collect()
    assert sorted(map(tuple, found)) == [("w", 0, "m", 4, 0), ("w", 0, "n", 1, 0)]
    plain = materialize(corpus.union(Corpus(corpus.sheets.limit(0), corpus.cells.limit(0), corpus.merges)),
                        str(tmp_path / "c"))
    assert plain.labels.count() == corpus.labels.count() == 5  # no number without a letter, no blank, no %


def test_a_corpus_written_without_the_index(spark, tmp_path):
    g2 = catalog.g2(spark, SF)
    write_corpus(g2, str(tmp_path / "b"), labels=False)
    assert read_corpus(spark, str(tmp_path / "b")).labels is None


def test_flagship_pushdown_and_pruning(spark):
    corpus, program = _programs(spark)[0]
    profile = label_profile(corpus.cells, {0: program})
    reads = read_cells(corpus.cells, program.targets(own_profile(stored(profile), program)), list(program.columns))
    (labels,), (values,) = _cells_scans(_plan(profile)), _cells_scans(_plan(reads))
    # the anchor profile pass pushes its label predicates into the scan
    assert "EqualTo(text_key,jan)" in labels[0]
    # no step reads the formula column, and the value read does not read str
    assert "formula" not in labels[1] + values[1]
    assert "num:double" in values[1] and "str:" not in values[1]


def test_inspection_reads_texts_and_bitmaps(spark):
    corpus, program = _programs(spark)[2]
    profile = label_profile(corpus.cells, {0: program})
    reads = read_cells(corpus.cells, program.targets(own_profile(stored(profile), program)), list(program.columns))
    (labels,), (values,) = _cells_scans(_plan(profile)), _cells_scans(_plan(reads))
    assert "In(text_key" in labels[0]
    assert "num:" not in values[1] and "text:" in values[1]
    # weeks are counted from one row per sheet row, not from cells
    pairs = stored(program.find_pairs(own_profile(stored(profile), program)))
    assert not _cells_scans(_plan(program.week_counts(pairs)))
    counts = numeric_rows(corpus.cells)
    plan = _plan(counts)
    assert "PartitionFilters: [isnotnull(ctype" in plan and "= numeric)" in plan


def test_rows_without_stored_bitmaps_are_the_same(spark):
    g3 = catalog.g3(spark, SF)
    other = Corpus(g3.sheets, g3.cells, g3.merges)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(inspection_program(g3).table) == key(inspection_program(other).table)


def test_inspection_issues_alone_need_no_read(spark):
    g3 = catalog.g3(spark, SF)
    res = inspection_program(g3, store_reads=False)
    assert not _cells_scans(_plan(res.issues)) and _cells_scans(_plan(res.table))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(res.table) == key(inspection_program(g3).table)


def test_no_table_that_grows_is_broadcast(spark):
    """The estimate of a join side is the size of its compressed files: sheets, anchors and
    targets of a large corpus would come to the driver whole (F1 to F14)."""
    from cellfold.queries import QUERIES
    assert [q for q in ("region_members", "offset_lookup", "form_record") if "Broadcast" in _plan(QUERIES[q](spark, SF))] == []
    corpus = catalog.g2(spark, SF)
    jobs = corpus.sheets.select("workbook").distinct().withColumn("kind", F.lit("adequacy"))
    res = run_jobs(jobs, corpus)
    assert "Broadcast" not in _plan(res.form) + _plan(res.issues)


def test_grids_are_built_without_broadcast(spark):
    from cellfold.sources import grids
    assert "Broadcast" not in _plan(grids.g2_customer_quarters(spark, SF)) + _plan(grids.g3_slots(spark, SF))


def test_buckets_grow_with_the_cells(spark, tmp_path, monkeypatch):
    """As many buckets as shuffle partitions, however many cells, made a task sort ever more
    of them (F15 to F25); the number is known without making the cells twice."""
    from cellfold.sources import bronze, grids
    g3 = grids.g3_schedule_grid(spark, SF)
    assert g3.n_cells == g3.cells.count()
    monkeypatch.setattr(bronze, "CELLS_PER_BUCKET", 1000)
    assert materialize(g3, str(tmp_path / "a")).buckets == -(-g3.n_cells // 1000) > 8
    plain = replace(g3, n_cells=None)
    assert materialize(plain, str(tmp_path / "b")).buckets == -(-g3.n_cells // 1000)


def test_bronze_keeps_strings_and_keys_of_their_own(spark, tmp_path):
    """The move of cells leaves out a string or key that reads as the text: others come back whole."""
    rows = [("w", 0, r, 0, "formula", None, s, "A1", t, k) for r, (s, t, k) in enumerate(
        [("a", "a", "a"), ("a", "=b", "=b"), (None, "X ", "x"), (None, None, ""), ("s", None, ""), (None, "7", "7")])]
    corpus = Corpus(with_sheet_key(spark.createDataFrame([("w", 0, "S")], "workbook string, sheet_idx int, sheet string")),
                    spark.createDataFrame(rows, CELLS_SCHEMA), spark.createDataFrame([], MERGES_SCHEMA))
    back = materialize(corpus, str(tmp_path / "c")).cells.select(*CELLS_SCHEMA.names)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[2]) == rows


def test_targets_are_dealt_without_the_sheet_key(spark):
    """The sheet key of a target is taken after the move to the buckets, and the join with
    the cells needs no second one."""
    program = InspectionProgram(catalog.g3(spark, SF))
    corpus = program.corpus
    profile = own_profile(stored(mark_profile(corpus, [program])), program)
    plan = _plan(read_cells(corpus.cells, corpus.dealt(program.targets(profile)), list(program.columns)))
    assert re.search(r"Exchange hashpartitioning\(xxhash64\(", plan)
    assert not re.search(r"Exchange hashpartitioning\(sid#\d+L?, sid2#\d+L?, row#", plan)


def _values(df):
    return sorted(map(str, df.collect()))


def test_cells_of_a_grid_move_before_they_are_made(spark, tmp_path):
    """Every cell of a derived grid went through the one shuffle of cells (F19 to F22, F24);
    the fewer rows that they are made of do now, and the cells are the same."""
    from cellfold.sources import grids
    for i, build in enumerate((grids.g1_metric_grid, grids.g2_form_grid, grids.g3_schedule_grid)):
        corpus = build(spark, SF)
        plan = [line for line in _plan(corpus.lay(4)).splitlines() if re.search(r"Generate inline|Exchange", line)]
        assert "Generate inline" in plan[0] and any("Exchange hashpartitioning" in line for line in plan[1:])
        back = materialize(corpus, str(tmp_path / str(i))).cells
        assert _values(back.select(*CELLS_SCHEMA.names)) == _values(corpus.cells)
        assert back.filter(F.col("band") != F.shiftright("row", 8)).isEmpty()


def test_a_pair_moves_to_its_cells_and_to_its_block(spark, no_broadcast):
    """Texts, both week rows and counts of a pair each moved by themselves (F19, F20, F22, F24)."""
    corpus = catalog.g3(spark, SF)
    plan = _plan(inspection_program(corpus).table)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Bucketed: true") == 2
    program = InspectionProgram(corpus)
    profile = own_profile(stored(mark_profile(corpus, [program])), program)
    assert program.rows(profile).count() < program.targets(profile).count() / 3


def test_pairs_and_blocks_over_two_bands(spark, tmp_path):
    """A pair's planned row ends one band and its completed row starts the next."""
    g3 = catalog.g3(spark, SF)
    for down in (252, 251):  # of rows 3, 4 and 5: both parities meet the edge at 256
        cells = g3.cells.select(*CELLS_SCHEMA.names).withColumn("row", F.col("row") + down)
        merges = g3.merges.withColumns({c: F.col(c) + down for c in ("first_row", "last_row")})
        moved = materialize(Corpus(g3.sheets, cells, merges), str(tmp_path / str(down)))
        assert moved.cells.select("sid", "band").distinct().count() > g3.cells.select("sid", "band").distinct().count()
        for compat in (False, True):
            assert _values(inspection_program(moved, compat=compat).table) == _values(
                inspection_program(g3, compat=compat).table)


def test_planted_faults_leave_cells_in_their_buckets(spark, no_broadcast):
    """The labels that a fault removes were taken out by a union, which has no buckets, so that
    all cells moved in every read (F23)."""
    from cellfold.sources import grids
    for build, fault in ((catalog.g1, grids.g1_with_faults), (catalog.g2, grids.g2_with_faults),
                         (catalog.g3, grids.g3_with_faults)):
        corpus = build(spark, SF)
        faulty = fault(corpus)
        assert faulty.buckets == corpus.buckets
        plan = _plan(faulty.cells.groupBy("sid", "sid2", "band", "row").count())
        assert "Union" not in plan and "Bucketed: true" in plan


def test_a_union_of_derived_grids_lays_its_own_cells(spark, tmp_path):
    """The corpus of all jobs was made of grids that were written by themselves first, and its
    cells moved whole (F2)."""
    from cellfold.sources import grids
    built = [g(spark, SF) for g in (grids.g1_metric_grid, grids.g2_form_grid, grids.g3_schedule_grid)]
    corpus = built[0].union(built[1]).union(built[2])
    assert corpus.n_cells == sum(c.n_cells for c in built) and corpus.lay is not None
    assert built[0].union(replace(built[1], lay=None)).lay is None
    back = materialize(corpus, str(tmp_path / "u"), buckets=3)
    assert back.buckets == 3 and back.cells.count() == sum(c.cells.count() for c in built)
    assert _values(back.cells.select(*CELLS_SCHEMA.names)) == _values(corpus.cells)


def test_schedule_cells_are_made_by_generated_code(spark):
    """Cells of the schedule grid were made by an interpreted filter over an array (F1 to F4)."""
    from cellfold.sources import grids
    plan = _plan(grids.g3_schedule_grid(spark, SF).lay(4))
    assert "Generate inline(" in plan and "lambda c#" not in plan


def test_rows_dealt_to_the_bands_of_their_places(spark):
    from cellfold.sources.bronze import deal
    places = lambda *rows: [(r, r % 7) for r in rows]
    df = spark.createDataFrame([("w", 0, 1, places(3, 4)), ("w", 0, 2, places(255, 256)), ("w", 1, 3, places(5, 5000, 5001)),
                                ("w", 1, 4, []), ("w", 1, 5, [(None, 1)]), ("w", 1, 6, [(7, 0), (None, 1)])],
                               "workbook string, sheet_idx int, id int, p array<struct<row:int,col:int>>")
    dealt = deal(df, 3, F.col("p"))
    assert sorted((r["id"], r["band"], r["row"]) for r in dealt.collect()) == [
        (1, 0, 3), (1, 0, 4), (2, 0, 255), (2, 1, 256), (3, 0, 5), (3, 19, 5000), (3, 19, 5001), (6, 0, 7)]


def test_label_files_are_known_without_a_look_at_the_cells(spark, tmp_path):
    """The range of a label's file came from a sample, for which all cells were read once more."""
    from cellfold.sources.bronze import label_file
    corpus = materialize(catalog.derived_g2(spark, SF), str(tmp_path / "b"), buckets=9)
    files = corpus.labels.select(F.input_file_name().alias("f"), "key")
    spread_over = files.groupBy("key").agg(F.countDistinct("f").alias("n")).agg(F.min("n"), F.max("n")).first()
    assert spread_over[0] >= 1 and spread_over[1] == 3
    n = spark.range(20000).selectExpr("concat('w', id) AS workbook", "0 AS sheet_idx", "concat('t', id % 997) AS text_key")
    sizes = {r["f"]: r["count"] for r in n.groupBy(label_file(11).alias("f")).count().collect()}
    assert set(sizes) == set(range(9)) and max(sizes.values()) < 2 * min(sizes.values())


def test_bits_of_one_two_and_more_words(spark):
    from cellfold.plans.inspection import bits_between
    columns = [[], [0], [63, 64], [5, 70, 127], [1, 64, 129, 300, 16383], [61, 62, 63, 64, 65, 128]]
    rows = [(i, sorted({c // 64 for c in cs}), cs) for i, cs in enumerate(columns)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    data = [(i, [(w, signed(sum(1 << (c % 64) for c in cs if c // 64 == w))) for w in words]) for i, words, cs in rows]
    df = spark.createDataFrame(data, "i int, bits array<struct<word:int,mask:bigint>>")
    for first, end in ((0, 12), (60, 66), (49, 61), (63, 64), (64, 200), (0, 16384), (70, 70)):
        n = df.select("i", bits_between(F.col("bits"), F.lit(first), F.lit(end)).alias("n")).collect()
        assert {r["i"]: r["n"] for r in n} == {i: sum(first <= c < end for c in cs) for i, _, cs in rows}


def test_a_cell_or_region_given_twice_is_counted_once(spark):
    g3 = catalog.g3(spark, SF)
    plain = lambda df: df.select(*CELLS_SCHEMA.names)
    twice = Corpus(g3.sheets, plain(g3.cells).unionByName(plain(g3.cells)), g3.merges.unionByName(g3.merges))
    stages = [inspection_program(c).stages["pairs"] for c in (g3, twice)]
    assert _values(stages[0].select(*sorted(stages[0].columns))) == _values(stages[1].select(*sorted(stages[1].columns)))


def test_block_heads_come_without_the_pairs(spark):
    """All pairs were made a second time for the name and platform of their blocks (F1)."""
    stages = inspection_program(catalog.g3(spark, SF)).stages
    assert "Window" not in _plan(stages["heads"]) and "SortMergeJoin" not in _plan(stages["heads"])
    of_pairs = stages["pairs"].select("workbook", "sheet_idx", "region_id", F.col("Location").alias("loc_name"),
                                      F.col("Platform_Installation").alias("platform")).distinct()
    assert _values(stages["heads"].select(*of_pairs.columns)) == _values(of_pairs)


def test_unfiltered_rows_are_made_once(spark):
    """Rows before and after the header rows go were each made from the cells (F3)."""
    from cellfold.queries import QUERIES
    plan = _plan(QUERIES["exclude_header_rows"](spark, SF))
    assert "Window" not in plan and "Bucketed" not in plan


def test_reads_of_one_table_are_not_stored(spark):
    """The reads were written and read back for the one table made of them (F4)."""
    from cellfold.queries import QUERIES
    plan = _plan(QUERIES["region_carryover_compat"](spark, SF))
    assert len(_cells_scans(plan)) == 1 and "cellfold_reads" not in plan
