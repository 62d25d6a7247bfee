"""Published tables of a catalog database.

A published table points to a version's folder, below which every load has a folder of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylens.schemas import TableSpec

DATABASE = "analytics"


def published(spark: SparkSession, name: str, database: str = DATABASE) -> DataFrame:
    return spark.table(f"{database}.{name}")


def list_published(spark: SparkSession, database: str = DATABASE) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


# The fact table names the folder of the frames that reports share: as written, and, as long as no
# table was published since, as current.
_WRITTEN, _CURRENT = "paylens.shared.written", "paylens.shared.current"


def location(spark: SparkSession, database: str = DATABASE) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


_VERSIONED = "paylens.versioned"


def _properties(spark: SparkSession, name: str, database: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{name}`").collect()
    return {r["key"]: r["value"] for r in rows}


def versions_folder(spark: SparkSession, name: str, database: str = DATABASE) -> str:
    return f"{location(spark, database)}/versions/{name}"


def version_of(spark: SparkSession, name: str, database: str = DATABASE) -> str | None:
    """The folder a table points to; None for one that was not published in versions."""
    if not spark.catalog.tableExists(f"`{database}`.`{name}`"):
        return None
    if _VERSIONED not in _properties(spark, name, database):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{name}`").collect()
    (place,) = [r["data_type"] for r in rows if r["col_name"] == "Location"]
    return place.rstrip("/")


def create_at(spark: SparkSession, spec: TableSpec, version: str, database: str = DATABASE) -> None:
    """A table over a version's folder, in place of one that was made by other means."""
    table = f"`{database}`.`{spec.name}`"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({spec.ddl}) USING parquet "
        f"OPTIONS (recursiveFileLookup 'true') LOCATION '{version}' "
        f"TBLPROPERTIES ('{_VERSIONED}' = 'true')"
    )


def move_to(spark: SparkSession, name: str, version: str, database: str = DATABASE) -> None:
    """Point a table to another version, in one step."""
    table = f"`{database}`.`{name}`"
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    spark.catalog.refreshTable(table)


def shared_folder(spark: SparkSession, database: str, current: bool = True) -> str | None:
    if not spark.catalog.tableExists(f"`{database}`.`fact_payments`"):
        return None
    found = _properties(spark, "fact_payments", database)
    return found.get(_CURRENT if current else _WRITTEN)


def set_shared_folder(spark: SparkSession, database: str, folder: str) -> None:
    spark.sql(
        f"ALTER TABLE `{database}`.`fact_payments` "
        f"SET TBLPROPERTIES ('{_WRITTEN}' = '{folder}', '{_CURRENT}' = '{folder}')"
    )


def forget_shared(spark: SparkSession, database: str) -> None:
    """Called when a table is published: the shared frames are no longer those of the tables."""
    if shared_folder(spark, database):
        spark.sql(
            f"ALTER TABLE `{database}`.`fact_payments` UNSET TBLPROPERTIES IF EXISTS ('{_CURRENT}')"
        )


def delete_folder(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
