"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellfold.session import cut_lineage

INT64_MIN = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``."""
    return cut_lineage(df)


def doc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (a null id: of '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def id_text(column: str) -> Column:
    """An integer id as decimal text. Python stages carry ids so: a nullable long
    would reach pandas as a double and lose its last digits."""
    return F.col(column).cast("long").cast("string")


def with_long_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """The id that ``id_text`` made, as a long again."""
    return df.withColumn(name, F.col(name).cast("long"))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8.

    ``bytes.lower`` and ``bytes.split`` know ASCII letters and ASCII white
    space only, which is exactly this rule.
    """
    return utf8(text).lower().split()


def split_joined(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, with each word's start and end."""
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lens + 1) - 1
    return b" ".join(words), ends - lens, ends


def text_slices(texts: pa.Array, at_once: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``at_once`` bytes of text, at least one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    cuts = [0, *(np.flatnonzero(np.diff(size // at_once)) + 1).tolist(), len(texts)]
    return ((i, j) for i, j in zip(cuts, cuts[1:]) if j > i)


def sampled_cuts(rows: DataFrame, total: int, parts: int, key: Callable = lambda x: x,
                 each: int = 50) -> list:
    """About ``parts`` - 1 cuts of ``total`` rows into equal parts, from a sample of ``each``
    rows a part. ``key`` turns rows into one column to order by. Only the cuts reach the driver."""
    if parts < 2:
        return []
    share = min(1.0, each * parts / total)
    part = key(rows if share == 1.0 else rows.sample(share, seed=1))
    column = part.columns[0]
    part = checkpoint(part.orderBy(column))
    sizes = dict(part.groupBy(F.spark_partition_id()).count().collect())  # one number per partition
    before, found = {}, 0
    for p in sorted(sizes):
        before[p], found = found, found + sizes[p]
    step = max(1, round(found / parts))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = before.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            yield b.take(pa.array(range((step - 1 - at) % step, b.num_rows, step), pa.int64()))
            at += b.num_rows

    return part.mapInArrow(pick, part.schema).toArrow()[column].to_pylist()[:parts - 1]
