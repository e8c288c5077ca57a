"""A corpus pipeline from the operators of ``cellfold.llm``.

Each stage takes the documents that its predecessor kept and returns the
columns of ``documents``; the last returns what it wrote, read back. Stages
keep repeated rows apart only where their operator says so: the near-duplicate
stage keeps one row of a group, the mixing stage repeats rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cellfold.llm import decontam, mixing, quality, simhash
from cellfold.llm.common import table
from cellfold.llm.queries import token_file_digests
from cellfold.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of the smallest id, null ids last."""
    return simhash.representatives(docs.select(*COLUMNS), shingle=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any word inside a benchmark window."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Equal shares of characters for all sources, as many characters as came in."""
    return mixing.poisson_mix(docs.select(*COLUMNS)).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture in ascending doc_id order, read back."""
    return token_file_digests(docs)


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("mix_sources", mix_sources),
          ("token_output", token_output)]

#: The classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage_{name}_{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
