"""CSV sources and Parquet lake tables."""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens import constants as C
from paylens.operators.jobs import together
from paylens.schemas import SOURCES, SourceSpec


def read_csv(
    spark: SparkSession, path: str, spec: SourceSpec, multi_line: bool = False
) -> DataFrame:
    """Read a CSV source by the names in its header and cast the columns of ``spec``.

    Only the header is read ahead; there is no pass to infer types. Further columns stay
    text; whole numbers may be written as 1.0. Empty fields and the usual missing-value markers become NULL. A row that does
    not fit the header fails the read instead of losing values.

    ``multi_line`` is needed only for files with line breaks inside quoted fields; such
    files cannot be split over tasks.
    """
    raw = spark.read.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        nullValue="",
        emptyValue="",
        mode="FAILFAST",
        enforceSchema=False,
        multiLine=multi_line,
    )
    names = [(name, F.col(f"`{name}`")) for name in raw.columns]
    cleaned = raw.select(
        *[F.when(~value.isin(*C.MISSING_MARKERS), value).alias(name) for name, value in names]
    )
    return cleaned.withColumns(
        {c: _whole(c) if kind == "int" else F.col(c).cast(kind) for c, kind in spec.columns.items()}
    )


def _whole(name: str) -> Column:
    """Text as an int: 7 and 7.0 alike; a real fraction raises."""
    exact = F.col(name).cast("decimal(38,18)")
    error = F.concat(F.lit(f"{name} is not a whole number: "), F.col(name))
    return F.when(exact != F.floor(exact), F.raise_error(error).cast("int")).otherwise(
        exact.cast("int")
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_optional(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None if its path does not exist. Any other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_source(
    spark: SparkSession, source_dir: str, spec: SourceSpec, multi_line: bool = False
) -> DataFrame | None:
    """A CSV source of a folder, one file or a folder of files; None if it is optional and missing."""

    def read() -> DataFrame:
        return read_csv(spark, f"{source_dir}/{spec.file}", spec, multi_line)

    return read() if spec.required else read_optional(read)


def read_sources(
    spark: SparkSession, source_dir: str, multi_line: bool = False
) -> dict[str, DataFrame | None]:
    """All CSV sources of a folder; optional ones that are missing are None."""

    def one(spec: SourceSpec) -> DataFrame | None:
        return read_source(spark, source_dir, spec, multi_line)

    # finding the columns of a source is a small job of its own
    return together(spark, {name: partial(one, spec) for name, spec in SOURCES.items()})


def read_lake(
    spark: SparkSession, lake_dir: str, landed: Collection[str]
) -> dict[str, DataFrame | None]:
    """The sources that were landed in a lake folder; optional ones that were not are None."""

    def read(spec: SourceSpec) -> DataFrame | None:
        if spec.name in landed or spec.required:
            return read_parquet(spark, f"{lake_dir}/{spec.name}")
        return None

    return together(spark, {name: partial(read, spec) for name, spec in SOURCES.items()})
