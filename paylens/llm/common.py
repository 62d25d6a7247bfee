"""What the text operators share: reading documents, written intermediate tables, sizes.

Conventions that hold for every operator here:

* Only the named columns of an input are read, so further columns, whatever their names, do
  no harm and are not passed on unless the operator says so.
* A null text counts as the empty text. A null ``doc_id`` stays null in results and comes
  after all numbers wherever documents are ordered. Repeated rows are rows like any others.
* An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.session import work_dir

LAST = 2**63 - 1
WHITE = r"\x20\x09-\x0D"


_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    path = f"{work_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    if _noted.get() is not None:
        _noted.get().append(path)
    return path


@contextmanager
def noted() -> Iterator[list[str]]:
    """Collects the paths that scratch() gives out meanwhile."""
    paths: list[str] = []
    token = _noted.set(paths)
    try:
        yield paths
    finally:
        _noted.reset(token)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables in the shared folder; the list is empty afterwards."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    paths.clear()


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application."""
    app_id = spark.sparkContext.applicationId
    if app_id in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="paylens-"), "paylens_text.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder in ("", "llm"):
            for name in sorted(os.listdir(os.path.join(package, folder))):
                if name.endswith(".py"):
                    inner = os.path.join("paylens", folder, name)
                    out.write(os.path.join(package, folder, name), inner)
    spark.sparkContext.addPyFile(path)
    _shipped.add(app_id)


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text, for operators that go on in Python."""
    ship(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def order_key(doc_id: Column) -> Column:
    """doc_id for ordering: nulls after all numbers."""
    return F.coalesce(doc_id, F.lit(LAST))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def partitions_for(spark: SparkSession, total_bytes: int, target: int) -> int:
    """Partitions of about ``target`` bytes each, no fewer than the session's cores."""
    return max(spark.sparkContext.defaultParallelism, -(-int(total_bytes) // target), 1)


def lower(text: str) -> str:
    """A-Z lower-cased, nothing else changed (bytes know no other letters)."""
    return text.encode("utf-8", "replace").lower().decode("utf-8")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
