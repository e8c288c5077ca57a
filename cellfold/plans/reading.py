"""Programs over one corpus that share their reads of the large ``cells`` table.

A program says which label cells it looks for (``marks``), derives from what
is found the positions it wants (``targets``), and makes its table and its
issues from the cells read there (``finish``). All programs of a run are
served by two scans of ``cells``:

1. one filtered pass over the cells gives a profile of label marks per sheet row;
   a program that looks for cells of given texts only (``labels``) takes its marks
   from the label index instead, whose pages of other texts are not read;
2. the targets of all programs, one tagged table, are joined to the cells once.

Cells are stored in buckets of (sheet key, band of rows), and both steps group or join
within these, so cells never move: the profile is grouped where
the cells lie, and only targets are dealt to the buckets, several of a band as one row
(``Program.rows``). Profile and reads are written to the shared folder, the reads in the
buckets of the cells, so a program's table and its issues, and every program of the run,
come from the same rows, read once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.operators.locate import SHEET, read_cells
from cellfold.session import stored
from cellfold.sources.bronze import SHEET_ID, SHEET_ROW, Corpus, keyed, stored_in_buckets

#: columns of a target row: what it is for is told by tag, part and two numbers
TARGET = ["tag", "part", "n1", "n2", *SHEET, "row", "col"]


@dataclass(frozen=True)
class ProgramResult:
    """A program's output table, its issues, and named intermediate stages
    (plain DataFrames of the same plan, for inspection and per-operator checks)."""
    table: DataFrame
    issues: DataFrame
    stages: dict = field(default_factory=dict)


class Program:
    """One program over its own workbooks (``corpus`` holds their sheets and merges)."""

    #: columns of the cells read
    columns: tuple[str, ...] = ("ctype", "num", "str", "text")

    def __init__(self, corpus: Corpus):
        self.corpus = corpus

    def wanted(self) -> Column:
        """Which cells carry a mark."""
        raise NotImplementedError

    def labels(self) -> list[str] | None:
        """The text keys, if a cell carries a mark just by reading one of them, and the marks
        need its row, column and text key alone; None if it takes more."""
        return None

    def marks(self) -> dict[str, Column]:
        """Aggregates over the wanted cells of one sheet row; others may be among them."""
        raise NotImplementedError

    def targets(self, profile: DataFrame) -> DataFrame:
        """Rows of ``TARGET`` without the tag; also keeps the anchors found."""
        raise NotImplementedError

    def rows(self, profile: DataFrame) -> DataFrame:
        """What moves to the cells: the targets, or fewer rows of the same columns that stand
        for several ``places`` each."""
        return self.targets(profile)

    def places(self) -> Column:
        """The (part, row, col) that a row of ``rows`` stands for, as an array."""
        return F.array(F.struct("part", "row", "col"))

    def finish(self, reads: DataFrame) -> ProgramResult:
        """Table and issues from the program's targets with the cells read there."""
        raise NotImplementedError


def _marked(rows: DataFrame, programs: dict[int, Program]) -> DataFrame:
    aggs = [c.alias(f"p{i}_{name}") for i, p in programs.items() for name, c in p.marks().items()]
    return keyed(rows).groupBy(*SHEET_ROW).agg(*aggs)


def label_profile(cells: DataFrame, programs: dict[int, Program]) -> DataFrame:
    """One pass over the cells for all programs: per sheet row with a wanted cell, every
    program's marks (columns prefixed by the program's number)."""
    wanted = reduce(lambda a, b: a | b, [p.wanted() for p in programs.values()])
    return _marked(keyed(cells).filter(wanted), programs)


def index_profile(corpus: Corpus, programs: dict[int, Program]) -> DataFrame:
    """The same for programs that look for labels only, from the label index."""
    keys = sorted({k for p in programs.values() for k in p.labels()})
    return _marked(corpus.labelled(keys), programs)


def mark_profile(corpus: Corpus, programs: list[Program]) -> DataFrame:
    """The marks of all programs: from the label index where that is enough, else from
    the cells. A sheet row may come twice, with the marks of other programs."""
    indexed = {i: p for i, p in enumerate(programs) if corpus.labels is not None and p.labels() is not None}
    scanned = {i: p for i, p in enumerate(programs) if i not in indexed}
    parts = ([label_profile(corpus.cells, scanned)] if scanned else []) + (
        [index_profile(corpus, indexed)] if indexed else [])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def own_profile(profile: DataFrame, program: Program, i: int = 0) -> DataFrame:
    """The rows of a profile that have marks of the i-th program, on its sheets, by their own names."""
    names = list(program.marks())
    marked = reduce(lambda a, b: a | b, [F.col(f"p{i}_{name}").isNotNull() for name in names])
    return (profile.filter(marked)
            .select(*SHEET_ID, "row", *[F.col(f"p{i}_{name}").alias(name) for name in names])
            .join(keyed(program.corpus.sheets.select(*SHEET)), SHEET_ID).drop(*SHEET_ID))


def run_programs(corpus: Corpus, programs: list[Program], store_reads: bool = True) -> list[ProgramResult]:
    """Every program's result, from two scans of the corpus's cells for all together
    (one where the label index serves all of them).

    ``store_reads=False`` leaves the second scan to whoever uses a result: for a
    caller that takes issues alone which no read can cause, it is never made.
    """
    if not programs:
        return []
    profile = stored(mark_profile(corpus, programs), "profile")
    rows = []
    for i, p in enumerate(programs):
        rows.append(p.rows(own_profile(profile, p, i)).select(F.lit(i).alias("tag"), *TARGET[1:]))
    columns = [c for c in Program.columns if any(c in p.columns for p in programs)]
    places = reduce(lambda c, x: c.when(F.col("tag") == x[0], x[1].places()), enumerate(programs), F)
    targets = corpus.dealt(reduce(lambda a, b: a.unionByName(b), rows), places)
    reads = read_cells(corpus.cells, targets, columns)
    if store_reads:
        reads = stored_in_buckets(reads, "reads", corpus.buckets)
    return [p.finish(reads.filter(F.col("tag") == i).drop("tag")) for i, p in enumerate(programs)]


def run_program(program: Program, store_reads: bool = True) -> ProgramResult:
    return run_programs(program.corpus, [program], store_reads)[0]


__all__ = ["Program", "ProgramResult", "index_profile", "label_profile", "mark_profile",
           "run_program", "run_programs"]
