"""Corpus construction for the registered queries: grids derived from the
sf tables and persisted as bronze Parquet in the shared scratch folder (the
checkpoint folder the session names), like decoded workbooks would be.

Bronze is written once per Spark application and input folder and then read
by every program that needs it (decode once, query many times). A new
application derives it again; the written tables survive executor loss.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from cellfold.session import scratch_path
from cellfold.sources import grids
from cellfold.sources.bronze import Corpus, materialize

_DERIVED: dict[tuple, Corpus] = {}
_BRONZE: dict[tuple, Corpus] = {}
_YEARS: dict[tuple, list[int]] = {}


def _bronze(spark: SparkSession, key: tuple, build) -> Corpus:
    k = (spark.sparkContext.applicationId, *key)
    if k not in _BRONZE:
        name = "_".join(str(x) for x in key[:1] + key[2:])
        _BRONZE[k] = materialize(build(), scratch_path(spark, f"bronze_{name}_{uuid.uuid4().hex}"))
    return _BRONZE[k]


def _derived(spark: SparkSession, key: tuple, build) -> Corpus:
    k = (spark.sparkContext.applicationId, *key)
    if k not in _DERIVED:
        _DERIVED[k] = build()
    return _DERIVED[k]


def derived_g1(spark: SparkSession, sf_dir: str) -> Corpus:
    """The grid before its cells are written."""
    return _derived(spark, ("g1", sf_dir), lambda: grids.g1_metric_grid(spark, sf_dir))


def derived_g2(spark: SparkSession, sf_dir: str) -> Corpus:
    return _derived(spark, ("g2", sf_dir), lambda: grids.g2_form_grid(spark, sf_dir))


def derived_g3(spark: SparkSession, sf_dir: str, start: int = grids.WEEK_START,
               blocks: str = "type", repeat: bool = False) -> Corpus:
    return _derived(spark, ("g3", sf_dir, start, blocks, repeat),
                    lambda: grids.g3_schedule_grid(spark, sf_dir, start=start, blocks=blocks,
                                                   repeat=repeat))


def g1(spark: SparkSession, sf_dir: str) -> Corpus:
    return _bronze(spark, ("g1", sf_dir), lambda: derived_g1(spark, sf_dir))


def g2(spark: SparkSession, sf_dir: str) -> Corpus:
    return _bronze(spark, ("g2", sf_dir), lambda: derived_g2(spark, sf_dir))


def g3(spark: SparkSession, sf_dir: str, start: int = grids.WEEK_START,
       blocks: str = "type", repeat: bool = False) -> Corpus:
    return _bronze(spark, ("g3", sf_dir, start, blocks, repeat),
                   lambda: derived_g3(spark, sf_dir, start, blocks, repeat))


def everything(spark: SparkSession, sf_dir: str) -> Corpus:
    """The workbooks of the three grids as one stored corpus, as a run of many jobs has it:
    every cell is made and written once, whether or not a grid is also stored by itself."""
    return _bronze(spark, ("all", sf_dir), lambda: derived_g1(spark, sf_dir).union(
        derived_g2(spark, sf_dir)).union(derived_g3(spark, sf_dir)))


def g1_tabs(spark: SparkSession, sf_dir: str, ahead: int = 0) -> list[str]:
    """Tab names to ask for: one per ship year of the data, and ``ahead`` after the last."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _YEARS:
        _YEARS[k] = grids.ship_years(spark, sf_dir) or [0]
    years = _YEARS[k]
    return [grids.g1_tab(y) for y in [*years, *range(years[-1] + 1, years[-1] + 1 + ahead)]]
