"""Bronze table schemas, constructors and readers.

A workbook corpus is three long-form tables keyed by ``(workbook, sheet_idx)``;
rows and columns are 0-based. ``text`` is the formatted-text view of a cell
(for a formula: its source text), ``num`` the numeric value (for a formula:
the cached number), ``str`` the string value (for a formula: a cached string).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import md5
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.text import norm_key, norm_key_sql
from cellfold.session import scratch_path, spread, stored

SHEETS_SCHEMA = T.StructType([
    T.StructField("workbook", T.StringType()),
    T.StructField("sheet_idx", T.IntegerType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("sheet_key", T.StringType()),
])

CELLS_SCHEMA = T.StructType([
    T.StructField("workbook", T.StringType()),
    T.StructField("sheet_idx", T.IntegerType()),
    T.StructField("row", T.IntegerType()),
    T.StructField("col", T.IntegerType()),
    T.StructField("ctype", T.StringType()),
    T.StructField("num", T.DoubleType()),
    T.StructField("str", T.StringType()),
    T.StructField("formula", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("text_key", T.StringType()),
])

MERGES_SCHEMA = T.StructType([
    T.StructField("workbook", T.StringType()),
    T.StructField("sheet_idx", T.IntegerType()),
    T.StructField("decl_idx", T.IntegerType()),
    T.StructField("first_row", T.IntegerType()),
    T.StructField("last_row", T.IntegerType()),
    T.StructField("first_col", T.IntegerType()),
    T.StructField("last_col", T.IntegerType()),
])

CELL_TYPES = ("numeric", "string", "formula", "boolean", "blank", "error")
# xlsx format limit on columns: row*16384+col is a row-major position key.
MAX_COLS = 16384


SHEET_ID = ["sid", "sid2"]
#: a band is 2^8 rows of a sheet: rows that are read together lie together, and a very
#: large sheet is thousands of bands
BAND_BITS = 8
#: cells and numeric rows are stored in buckets of these columns
BUCKET = [*SHEET_ID, "band"]
#: one row of one sheet: the key of every read of cells
SHEET_ROW = [*BUCKET, "row"]
#: about 200 MB of rows in a task that sorts them
CELLS_PER_BUCKET = 1_000_000
WORD = 64  # columns of one word of a row's bitmap
#: cells of a block that one projection writes out by generated code
GENERATED_CELLS = 16


def sheet_id() -> list[Column]:
    """128-bit numeric sheet key in two columns, from (workbook, sheet_idx).

    Reads of the large ``cells`` table are keyed on these instead of the
    workbook string (a file path at scale). The two 64-bit hashes chain the
    columns in opposite order, so sheets that share one differ in the other.
    """
    return [F.xxhash64("workbook", "sheet_idx").alias("sid"),
            F.xxhash64("sheet_idx", "workbook").alias("sid2")]


def band(row: Column | str = "row") -> Column:
    return F.shiftright(row, BAND_BITS)


def _in_bands(df: DataFrame, rows: Column) -> DataFrame:
    """``df`` once for each band that an array of rows (NULL: none) lies in, with that ``band``.
    Nearly always it is one, told by the smallest and the largest row, for which Spark
    generates code; the functions over array elements are interpreted, and left to rows that
    lie apart."""
    r, first, last = F.col("_rows"), F.col("_first"), F.col("_last")
    bands = F.when(first == last, F.array(first)).otherwise(F.array_distinct(F.transform(F.array_compact(r), band)))
    return (df.withColumn("_rows", rows)
            .withColumns({"_first": band(F.array_min(r)), "_last": band(F.array_max(r))})
            .select(*df.columns, F.explode(bands).alias("band")))


def keyed(df: DataFrame) -> DataFrame:
    """``df`` with its sheet key, and its band if it has rows: stored in bronze, else computed."""
    key = [] if "sid" in df.columns else sheet_id()
    if "row" in df.columns and "band" not in df.columns:
        key.append(band().alias("band"))
    return df.select("*", *key) if key else df


def deal(df: DataFrame, n: int | None, places: Column | None = None) -> DataFrame:
    """``df`` (workbook, sheet_idx, row and others) with its key, dealt to n buckets of
    ``BUCKET`` (None: not dealt). The key, 16 bytes that no codec makes shorter, is taken
    after the move.

    ``places``: the array of structs with a ``row`` that a row of ``df`` stands for. The row
    moves once for each band that it has places in, and is written out there: the structs'
    fields take the place of its columns of these names.
    """
    if places is None:
        if n is None:
            return keyed(df)
        return df.repartition(n, *sheet_id(), band()).select("*", *sheet_id(), band().alias("band"))
    fields = df.select(F.inline(places)).columns
    if n is None:
        return keyed(df.select(*[c for c in df.columns if c not in fields], F.inline(places)))
    moved = _in_bands(df, places["row"]).repartition(n, *sheet_id(), "band")
    # in order before they are written out: a join then sorts them with few comparisons
    moved = moved.sortWithinPartitions(*sheet_id(), "row") if "row" in df.columns else moved
    return (moved.select(*sheet_id(), "band", *[c for c in df.columns if c not in fields], F.inline(places))
            .filter(band() == F.col("band")))


def buckets_of(cells: DataFrame) -> int | None:
    """In how many buckets cells are stored, as ``read_corpus`` notes it; None if they are not."""
    return cells.schema["band"].metadata.get("buckets") if "band" in cells.columns else None


def numeric_rows(cells: DataFrame) -> DataFrame:
    """One row per sheet row with numeric cells: which columns they are in, as words of
    64 bits (``bits``: word, mask; at most 256 words). Output: sid, sid2, row, bits."""
    words = (keyed(cells).filter(F.col("ctype") == "numeric")
             .groupBy(*SHEET_ROW, F.expr(f"col div {WORD}").cast("int").alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, col % {WORD})")).alias("mask")))
    return words.groupBy(*SHEET_ROW).agg(F.collect_list(F.struct("word", "mask")).alias("bits"))


#: what a text key must hold to be in the label index: a letter, or any character outside
#: ASCII. Numbers, dates, dashes and blanks, which fill most of a sheet, are left out.
LABEL_SIGN = r"[a-z]|[^\x00-\x7F]"


def label_index(cells: DataFrame) -> DataFrame:
    """Where each text is found: key (hash of ``text_key``), sid, sid2, row, col, text_key.
    Cells of any type whose text holds a ``LABEL_SIGN``."""
    return (keyed(cells).filter(F.col("text_key").rlike(LABEL_SIGN))
            .select(F.xxhash64("text_key").alias("key"), *SHEET_ID, "row", "col", "text_key"))


#: rows of a page of the label index: the least that a look-up reads of a file
LABELS_PER_PAGE = 5000


def label_file(n: int) -> Column:
    """Which of n files of the label index a cell is in: by the range of its text's hash and
    the range of its sheet key. Hashes are spread evenly, so the ranges are known without
    looking at the cells; the texts that fill a corpus are dealt over the ranges of sheets."""
    across = max(1, isqrt(n))

    def part(h: Column, parts: int) -> Column:
        upper = F.shiftright(h, 40) + (1 << 23)  # 0 .. 2^24 - 1, in the order of the hashes
        return F.shiftright(upper * parts, 24)

    return (part(F.xxhash64("text_key"), n // across) * across + part(sheet_id()[0], across)).cast("int")


@dataclass(frozen=True)
class Corpus:
    """The bronze tables of one corpus of workbooks. ``rows``: the bitmaps of numeric
    columns, stored beside the cells; taken from the cells where they are not stored.
    ``labels``: the label index, or None where it is not stored. ``buckets``: in how many
    buckets cells and rows are stored, if they are; ``n_cells``: about how many cells there
    are, where that is known before they are made; ``lay``: makes the cells in a given number
    of buckets from the fewer rows that they are derived of, which move in their stead."""
    sheets: DataFrame
    cells: DataFrame
    merges: DataFrame
    rows: DataFrame | None = None
    labels: DataFrame | None = None
    buckets: int | None = None
    n_cells: int | None = None
    lay: Callable[[int], DataFrame] | None = None

    def numeric_rows(self) -> DataFrame:
        return numeric_rows(self.cells) if self.rows is None else self.rows

    def labelled(self, keys: list[str]) -> DataFrame:
        """The cells whose ``text_key`` is one of ``keys`` (sid, sid2, row, col, text_key),
        looked up in the label index. A key that the index leaves out (no ``LABEL_SIGN``:
        blank, a number, '%'), or a corpus without one, takes a scan of the cells."""
        is_key = F.col("text_key").isin(keys)
        columns = [*SHEET_ID, "row", "col", "text_key"]
        if self.labels is None or not all(re.search(LABEL_SIGN, k) for k in keys):
            return keyed(self.cells).filter(is_key).select(*columns)
        # the hashes are constants, so they reach the row groups' and pages' bounds
        return self.labels.filter(F.col("key").isin([F.xxhash64(F.lit(k)) for k in keys]) & is_key).select(*columns)

    def dealt(self, df: DataFrame, places: Column | None = None) -> DataFrame:
        """``df`` dealt to the buckets of cells and rows (``deal``)."""
        return deal(df, self.buckets, places)

    def union(self, other: "Corpus") -> "Corpus":
        """Both corpora; cells have the columns of ``CELLS_SCHEMA`` (a union has no buckets).
        Of two derived corpora that lay their own cells, the union lays those of both."""
        cells = [c.cells.select(*[f.name for f in CELLS_SCHEMA.fields]) for c in (self, other)]
        known = self.n_cells is not None and other.n_cells is not None
        derived = self.lay is not None and other.lay is not None
        return Corpus(self.sheets.unionByName(other.sheets), cells[0].unionByName(cells[1]),
                      self.merges.unionByName(other.merges),
                      n_cells=self.n_cells + other.n_cells if known else None,
                      lay=(lambda n: self.lay(n).unionByName(other.lay(n))) if derived else None)


def with_sheet_key(sheets: DataFrame) -> DataFrame:
    return sheets.withColumn("sheet_key", norm_key("sheet"))


def finish_cells(cells: DataFrame, key: list[str] = []) -> DataFrame:
    """Add ``text_key``, if it is not there yet, and put the columns in bronze order, after
    those of the ``key``."""
    if "text_key" not in cells.columns:
        cells = cells.withColumn("text_key", norm_key("text"))
    return cells.select(*key, *[F.col(f.name).cast(f.dataType) for f in CELLS_SCHEMA.fields])


def sql_lit(v) -> str:
    """A Python constant as SQL literal text."""
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def cell(row, col, ctype: str, num=None, s=None, text=None, formula=None,
         when: str | None = None) -> str:
    """One cell as SQL struct text, for building grids in a single projection.

    ``row``/``col``/``num`` are SQL expressions (int/float constants allowed),
    ``s``/``text``/``formula`` SQL expressions; wrap a Python string constant
    with ``sql_lit``. ``when`` makes the cell conditional (absent otherwise). The
    text key is made here, where that of a constant text is a constant.
    """
    def x(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        return f"CAST({v} AS {t})"
    body = (f"named_struct('row', {x(row, 'INT')}, 'col', {x(col, 'INT')}, "
            f"'ctype', '{ctype}', 'num', {x(num, 'DOUBLE')}, 'str', {x(s, 'STRING')}, "
            f"'formula', {x(formula, 'STRING')}, 'text', {x(text, 'STRING')}, "
            f"'text_key', {norm_key_sql(x(text, 'STRING'))})")
    return f"CASE WHEN {when} THEN {body} END" if when else body


def string_cell(row, col, value: str, when: str | None = None) -> str:
    """A string cell holding a constant."""
    v = sql_lit(value)
    return cell(row, col, "string", s=v, text=v, when=when)


def number_text_sql(x: str) -> str:
    """Plain rendering of a numeric cell as SQL: integers without a point,
    else the shortest decimal text."""
    return (f"CASE WHEN {x} = floor({x}) AND abs({x}) < 1e15 "
            f"THEN CAST(CAST({x} AS BIGINT) AS STRING) ELSE CAST({x} AS STRING) END")


def explode_cells(df: DataFrame, keys: list[str], cell_structs: list[str],
                  once: tuple[str, list[str]] | None = None) -> DataFrame:
    """Turn one row per sheet (or block) into one row per cell, in ONE
    projection (``inline`` of a struct array); NULL entries (absent cells)
    are dropped. ``once``: a condition, and further cells of the rows that meet it."""
    arr = "array(" + ", ".join(cell_structs) + ")"
    # few cells are written out by generated code; that of many is one method, too long for
    # the JVM to compile, so that these are better interpreted, as ``filter`` is
    few = len(cell_structs) <= GENERATED_CELLS
    if not few:
        arr = f"filter({arr}, c -> c IS NOT NULL)"
    if once:
        arr = f"concat({arr}, IF({once[0]}, array({', '.join(once[1])}), array()))"
    cells = df.selectExpr(*keys, f"inline({arr})")
    return cells.filter(F.col("ctype").isNotNull()) if few else cells


def lay_cells(blocks: DataFrame, rows: Column, cell_structs: list[str], n: int,
              once: tuple[str, list[str]] | None = None) -> DataFrame:
    """The cells of ``blocks`` (workbook, sheet_idx and what ``cell_structs`` reads) in n
    buckets, with their key: blocks are dealt, and written out cell by cell where the cells
    are to lie. ``rows``: the rows of the sheet (NULL: none) that a block has cells in."""
    dealt = _in_bands(blocks, rows).repartition(n, *sheet_id(), "band")
    keys = [*BUCKET, "workbook", "sheet_idx"]
    cells = explode_cells(dealt.select("*", *sheet_id()), keys, cell_structs, once).filter(band() == F.col("band"))
    return finish_cells(cells, BUCKET)


def _table(path: str, kind: str) -> str:
    return f"cellfold_{kind}_{md5(path.rstrip('/').encode()).hexdigest()[:20]}"


#: files that a task writes at once: its bucket, in a file per cell type
FILES_AT_ONCE = 8


def _write_bucketed(df: DataFrame, path: str, kind: str, mode: str, buckets: int,
                    partition: str | None = None) -> None:
    """A table in buckets of ``BUCKET`` at ``path``, from rows that are dealt by it already, in
    the order in which they come. Spark does not know that a task holds one bucket, and would
    sort all rows by bucket first: instead a task has its few files open at once."""
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *BUCKET)
    if partition:
        w = w.partitionBy(partition)
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name, None)
    conf.set(name, str(FILES_AT_ONCE))
    try:
        w.option("path", f"{path}/{kind}").saveAsTable(_table(path, kind))
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def _bucketed(spark: SparkSession, path: str, kind: str, ddl: str, buckets: int,
              partition: str | None = None) -> DataFrame:
    """The bucketed table at ``path``, entered in the session's catalog if it is not there."""
    name, key = _table(path, kind), ", ".join(BUCKET)
    if not spark.catalog.tableExists(name):
        part = f"PARTITIONED BY ({partition})" if partition else ""
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet {part} CLUSTERED BY ({key}) "
                  f"INTO {buckets} BUCKETS LOCATION {sql_lit(f'{path}/{kind}')}")
        if partition:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).withMetadata("band", {"buckets": buckets})


def stored_in_buckets(df: DataFrame, name: str, n: int | None) -> DataFrame:
    """``df``, dealt to n buckets already, written once to the shared folder and read back in
    these buckets; as ``session.stored`` does it if n is None."""
    if n is None:
        return stored(df, name)
    path = scratch_path(df.sparkSession, f"{name}_{uuid.uuid4().hex}")
    _write_bucketed(df, path, name, "overwrite", n)
    return spread(df.sparkSession.table(_table(path, name)))


_CELLS_DDL = ", ".join(["sid BIGINT, sid2 BIGINT, band INT", *[f"{f.name} {f.dataType.simpleString()}"
                                                     for f in CELLS_SCHEMA.fields]])
_LABELS_DDL = "key BIGINT, sid BIGINT, sid2 BIGINT, row INT, col INT, text_key STRING"
_ROWS_DDL = "sid BIGINT, sid2 BIGINT, band INT, row INT, bits ARRAY<STRUCT<word: INT, mask: BIGINT>>"


def _dealt(cells: DataFrame, n: int) -> DataFrame:
    """Cells with their sheet key, dealt to the buckets: the one shuffle of cells, here and
    never again. What the other columns tell does not move: the sheet key, and the string
    or text key that reads as the text does."""
    text = F.col("text")
    moved = cells.select(*[f.name for f in CELLS_SCHEMA.fields if f.name not in ("str", "text_key")],
                         *[x for c in ("str", "text_key") for x in (
                             F.col(c).eqNullSafe(text).alias(f"{c}_is_text"),
                             F.when(~F.col(c).eqNullSafe(text), F.col(c)).alias(f"{c}_own"))])
    moved = moved.repartition(n, *sheet_id(), band())
    back = {c: F.when(F.col(f"{c}_is_text"), text).otherwise(F.col(f"{c}_own")) for c in ("str", "text_key")}
    return moved.select(*sheet_id(), band().alias("band"), *[back.get(f.name, F.col(f.name)).alias(f.name) for f in CELLS_SCHEMA.fields])


def read_corpus(spark: SparkSession, path: str) -> Corpus:
    """Read a bronze corpus written by ``write_corpus``, with its buckets. All its tables
    grow with the corpus, so none of them is broadcast (``spread``)."""
    # a bucket holds whole bands, so that a join by row finds both sides dealt: Spark would
    # move them once more, by all of the join's columns
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    layout = spark.read.parquet(f"{path}/layout").first().asDict()
    n = layout["buckets"]
    labels = spread(spark.read.schema(_LABELS_DDL).parquet(f"{path}/labels")) if layout.get("labels") else None
    return Corpus(spread(spark.read.parquet(f"{path}/sheets")),
                  spread(_bucketed(spark, path, "cells", _CELLS_DDL, n, "ctype")),
                  spread(spark.read.parquet(f"{path}/merges")),
                  spread(_bucketed(spark, path, "rows", _ROWS_DDL, n)), labels, n)


def write_corpus(corpus: Corpus, path: str, mode: str = "overwrite", buckets: int | None = None,
                 labels: bool = True) -> None:
    """Write bronze tables as Parquet.

    ``cells`` carries the numeric sheet key and is stored in buckets of (key,
    band of rows), sorted by row and column within, so every read of cells by sheet and
    row joins a bucket where it lies. It is also partitioned by ``ctype`` (at most
    six values): a step that reads one kind of cell prunes the others. ``rows``
    holds the bitmaps of numeric columns, in the same buckets. One sheet's bands
    spread over all buckets, so a very large sheet makes no hot bucket.

    ``labels`` is the inverted table of texts: a file for each of about sqrt(buckets)
    ranges of the text's hash and as many of the sheet key (``label_file``), in order of
    (hash, sheet key, row). So a label is a range of rows in the files of its hash, which
    a reader finds by the bounds of row groups and pages, and a label that every sheet
    has spreads over several files. ``labels=False`` leaves it out (label searches then
    scan cells).

    buckets: if not given, as many as shuffle partitions, so that the other side
    of a read is dealt to as many tasks as any shuffle, and more where a bucket would
    hold over ``CELLS_PER_BUCKET`` cells: a task sorts its bucket in memory, whatever
    the size of the corpus.
    """
    spark = corpus.cells.sparkSession
    if buckets is None:
        n_cells = corpus.cells.count() if corpus.n_cells is None else corpus.n_cells
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_cells // CELLS_PER_BUCKET))
    n = buckets
    corpus.sheets.write.mode(mode).parquet(f"{path}/sheets")
    corpus.merges.write.mode(mode).parquet(f"{path}/merges")
    cells = _dealt(corpus.cells, n) if corpus.lay is None else corpus.lay(n)
    # nearly in order, a read sorts them by row with few comparisons
    cells = cells.sortWithinPartitions(*SHEET_ROW, "col")
    _write_bucketed(cells, path, "cells", mode, n, "ctype")
    written = _bucketed(spark, path, "cells", _CELLS_DDL, n, "ctype")
    _write_bucketed(numeric_rows(written), path, "rows", mode, n)
    if labels:
        # hash and sheet key are taken again after the move
        found = (written.filter(F.col("text_key").rlike(LABEL_SIGN))
                 .select("workbook", "sheet_idx", "row", "col", "text_key")
                 .repartitionById(n, label_file(n)))
        (label_index(found).sortWithinPartitions("key", *SHEET_ID, "row")
         .write.mode(mode).option("parquet.page.row.count.limit", LABELS_PER_PAGE).parquet(f"{path}/labels"))
    spark.createDataFrame([(n, labels)], "buckets int, labels boolean").write.mode(mode).parquet(f"{path}/layout")


def materialize(corpus: Corpus, path: str, buckets: int | None = None) -> Corpus:
    """Persist a derived corpus as bronze Parquet at ``path`` (shared storage)
    and return the tables read back: later plans start from a plain scan
    (pushdown, pruning, no recomputation) and survive executor loss."""
    write_corpus(corpus, path, buckets=buckets)
    return read_corpus(corpus.cells.sparkSession, path)
