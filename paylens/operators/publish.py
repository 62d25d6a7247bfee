"""Writing marts and publishing them as fixed-schema tables without NULLs.

What is written replaces nothing until it is complete. A folder is written beside its place and swapped
in. A published table consists of a version's folder with one folder per load; a reload writes a new
version and then points the table to it, an append adds the load's folder in one step. A load is known
by its id, so appending it again changes nothing. A write that fails or is killed leaves the rows
of before; what it left behind is deleted by the next reload.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paylens.operators.folders import Files, beside, swap_in
from paylens.schemas import TableSpec
from paylens.sources.catalog import (
    DATABASE,
    create_at,
    forget_shared,
    move_to,
    published,
    version_of,
    versions_folder,
)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def clustered(df: DataFrame, key: str, files: int | None = None) -> DataFrame:
    """Rows sorted on a key inside each file.

    With ``files``, that many of about the same size whose ranges of the key do not overlap, so that a
    filter on the key reads few of them: this takes a pass to sample the key and a shuffle. Rows of
    one very frequent key are spread over files by a hash of the whole row. Without it, rows stay in
    their tasks.
    """
    if files == 1:
        df = df.repartition(1)
    elif files:
        df = df.repartitionByRange(files, key, F.xxhash64(*df.columns))
    return df.sortWithinPartitions(key)


def write_parquet(
    df: DataFrame,
    path: str,
    cluster_by: str | None = None,
    append: bool = False,
    check: Callable[[], None] = lambda: None,
) -> int:
    """Write a frame and return its number of rows, counted while writing.

    A folder that is replaced stays until the new one is complete and ``check`` has not raised.
    """
    counted, rows = _counted(df)
    if cluster_by:
        counted = clustered(counted, cluster_by)
    if append:
        counted.write.mode("append").parquet(path)
        return rows.get["rows"]
    new = beside(path, f"new-{uuid4().hex}")
    try:
        counted.write.parquet(new)
        check()
        swap_in(df.sparkSession, new, path)
    except BaseException:
        Files(df.sparkSession).delete(new)
        raise
    return rows.get["rows"]


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of ``spec`` in order and with its types; a value that does not fit raises."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in spec.columns.items()])


def normalise(df: DataFrame, spec: TableSpec) -> DataFrame:
    """As published: conformed, missing text is '' and missing numbers are 0."""
    texts = [c for c, kind in spec.columns.items() if kind == "string"]
    numbers = [c for c, kind in spec.columns.items() if kind != "string"]
    out = conform(df, spec)
    out = out.na.fill("", texts) if texts else out
    return out.na.fill(0, numbers) if numbers else out


def publish_path(df: DataFrame, spec: TableSpec, path: str, append: bool = False) -> int:
    """Publish into a folder."""
    return write_parquet(normalise(df, spec), path, spec.cluster_by, append)


def ensure_database(
    spark: SparkSession, database: str = DATABASE, location: str | None = None
) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def loads_of(spark: SparkSession, spec: TableSpec, database: str = DATABASE) -> list[str]:
    """The ids of the loads a published table consists of."""
    version = version_of(spark, spec.name, database)
    names = Files(spark).names(version) if version else []
    return [name.removeprefix("load-") for name in names if name.startswith("load-")]


def publish_table(
    spark: SparkSession,
    df: DataFrame | None,
    spec: TableSpec,
    database: str = DATABASE,
    append: bool = False,
    load_id: str | None = None,
    files: int | None = None,
) -> int | None:
    """Publish into a catalog table, creating it if absent, and return the rows loaded.

    The rows replace those of the table, or are added with ``append``, unless the table already holds
    the load of this id. Without a mart (None) nothing happens and an earlier table stays as it is. A
    table that exists with other columns, in another order or with other types raises before
    anything is changed. Any failure leaves the table with the rows of before. ``files``: see
    ``clustered``. The version before is kept for queries that still read it, until the next reload.

    One load of a table runs at a time; two reloads side by side leave the later one's rows.
    """
    if df is None:
        return None
    ensure_database(spark, database)
    table, wanted = f"`{database}`.`{spec.name}`", list(spec.columns.items())
    exists = spark.catalog.tableExists(table)
    if exists and (found := spark.table(table).dtypes) != wanted:
        raise ValueError(f"{table} has columns {found}, but {wanted} are to be loaded")
    disk, load = Files(spark), load_id or uuid4().hex
    current = version_of(spark, spec.name, database) if exists else None
    if append and load in loads_of(spark, spec, database):
        return spark.read.schema(spec.ddl).parquet(f"{current}/load-{load}").count()

    folder = versions_folder(spark, spec.name, database)
    version = current if append and current else f"{folder}/version-{uuid4().hex}"
    staged = f"{version}/_load-{load}"
    disk.delete(staged)
    counted, rows = _counted(normalise(df, spec))
    try:
        clustered(counted, spec.cluster_by, files).write.parquet(staged)
        if append and exists and not current:  # made by other means: its rows are taken along
            published(spark, spec.name, database).write.parquet(f"{version}/load-before")
    except BaseException:
        disk.delete(version if version != current else staged)
        raise
    if spec.name in ("fact_payments", "customer_segments"):
        forget_shared(spark, database)
    disk.rename(staged, f"{version}/load-{load}")
    if version == current:
        spark.catalog.refreshTable(table)
        return rows.get["rows"]
    if current:
        move_to(spark, spec.name, version, database)
    else:
        create_at(spark, spec, version, database)
    kept = {v.rsplit("/", 1)[-1] for v in (version, current) if v}
    for name in set(disk.names(folder)) - kept:
        disk.delete(f"{folder}/{name}")
    return rows.get["rows"]
