"""The corpus pipeline: documents judged, deduplicated, decontaminated and mixed.

Every stage reads all that the one before it kept and passes on the columns of ``documents``; the
last adds ``mix_copy``, the number of the copy, as documents may be taken more than once. Nulls,
empty texts and repeated rows are treated as each operator's module says.

A stage's result is to be written before the next stage is called: what a stage has written for itself
is deleted then, and ``run`` deletes a stage's input when its output is written, so that the shared folder
holds the tables of one stage at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from paylens.llm.common import delete, noted, read_table, saved
from paylens.llm.decontamination import WHOLE, drop_leaks
from paylens.llm.exact_dedup import keep_first
from paylens.llm.mixing import mix_documents
from paylens.llm.near_dedup import keep_one
from paylens.llm.quality import keep_good

NEAR_SIMILARITY = 0.8
# Rows go to Python in batches of at most so many bytes. Whatever a batch needs, the JVM and a worker
# keep for the rest of the job, beside the heap: at Spark's 64 MB, hundreds of MB of an executor.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 * 1024 * 1024

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: dict[str, list[str]] = {}  # by application: tables of the stage called last


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of a running session, unless it has a bound of its own."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def _tidy(stage: Stage) -> Stage:
    """The stage, after the tables that the one before has left are deleted."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app_id = spark.sparkContext.applicationId
        small_batches(spark)
        delete(spark, _left.get(app_id, []))
        with noted() as paths:
            out = stage(spark, docs, sf_dir)
        _left[app_id] = paths
        return out

    return run_stage


@_tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


@_tidy
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of all documents with the same text."""
    return keep_first(docs)


@_tidy
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return keep_one(docs, similarity=NEAR_SIMILARITY)


@_tidy
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"), **WHOLE)


@_tidy
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]
# A trained classifier, minwise trees and hashed draws cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over what the one before it kept, written and read again."""
    docs, read = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        with noted() as written:
            docs = saved(out, name.replace(" ", "-"))
        delete(spark, read)  # what the stage has read; never the caller's table
        read = written
    delete(spark, _left[spark.sparkContext.applicationId])
    return docs
