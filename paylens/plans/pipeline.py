"""The whole job in three stages: extract, transform, load.

The stages pass state only through the lake folder, so each one can be run again alone:

    <lake>/<source>                      landed sources
    <lake>/transformed/<mart>            marts
    <lake>/manifest/<stage>/<name>.json  what has been written, and from which input

A source or mart without an entry for the present input counts as missing, even if files of an
earlier run are still there. A stage that was ended half-way, or is run again, leaves alone what is
complete and was made from the same input; ``fresh`` makes everything anew.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from paylens.operators.folders import Files, recover
from paylens.operators.ingest import Landed, land
from paylens.operators.jobs import together
from paylens.operators.manifest import Entry, Manifest, Rows, identity
from paylens.operators.publish import ensure_database, loads_of, publish_table
from paylens.plans.tables import ReportTables, refresh_shared
from paylens.plans.warehouse import Warehouse
from paylens.schemas import SOURCES, TABLES, SourceSpec, TableSpec
from paylens.session import partitions_for, size_of
from paylens.sources.catalog import DATABASE, shared_folder
from paylens.sources.files import read_lake, read_parquet, read_source

# Marts built from the written order fact; the others need sources only.
FROM_FACT = (
    "customer_segments",
    "revenue_by_state",
    "installment_analysis",
    "payment_method_analysis",
    "revenue_leakage",
)


@dataclass
class Extracted:
    """Rows read and kept per source (None: not there), and orders per status."""

    sources: dict[str, Landed | None]
    statuses: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> Rows:
        return {name: x and x.rows_kept for name, x in self.sources.items()}


@dataclass
class PipelineRun:
    """What each stage has written (None: skipped), and the published tables."""

    spark: SparkSession
    database: str
    extracted: Extracted
    transformed: Rows
    loaded: Rows

    @property
    def landed(self) -> Rows:
        return self.extracted.rows

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {
            name: self.spark.table(f"{self.database}.{name}")
            for name in TABLES
            if self.spark.catalog.tableExists(f"{self.database}.{name}")
        }

    def report_tables(self) -> ReportTables:
        return ReportTables.from_catalog(self.spark, self.database)

    def load_report(self) -> DataFrame:
        return self.spark.createDataFrame(list(self.loaded.items()), "table string, rows bigint")

    def ingest_report(self) -> DataFrame:
        """Rows read and kept of each source that was there."""
        rows = [
            (name, x.rows_read, x.rows_kept) for name, x in self.extracted.sources.items() if x
        ]
        return self.spark.createDataFrame(rows, "source string, rows_read bigint, rows_kept bigint")


def _source_input(spark: SparkSession, path: str, multi_line: bool) -> str | None:
    """Names the present content of a source by its files; None if there are none."""
    found = Files(spark).listing(path)
    return None if found is None else identity([found, multi_line])


def extract(
    spark: SparkSession,
    source_dir: str,
    lake_dir: str,
    multi_line: bool = False,
    fresh: bool = False,
) -> Extracted:
    """Land each source as Parquet, payments without the invalid ones."""
    manifest = Manifest(spark, lake_dir, "extract")

    def one(spec: SourceSpec) -> Landed | None:
        path, source = f"{lake_dir}/{spec.name}", f"{source_dir}/{spec.file}"
        made_from = _source_input(spark, source, multi_line)
        recover(spark, path)
        entry = None
        if made_from and not fresh and Files(spark).exists(path):
            entry = manifest.current(spec.name, made_from)
        if not entry:
            manifest.drop(spec.name)
            df = read_source(spark, source_dir, spec, multi_line)
            if df is None:
                manifest.put(spec.name, Entry.of("", None))
                return None
            done = land(df, spec, path)
            figures = {"rows_read": done.rows_read, "counts": done.statuses}
            entry = manifest.put(spec.name, Entry.of(made_from, done.rows_kept, **figures))
        return Landed(entry.rows_read, entry.rows, entry.counts)

    done = Extracted(together(spark, {name: partial(one, spec) for name, spec in SOURCES.items()}))
    done.statuses = done.sources["orders"].statuses
    return done


def transform(spark: SparkSession, lake_dir: str, fresh: bool = False) -> Rows:
    """Build the marts whose sources were landed. Those that need no fact run beside it."""
    landed = {
        name: entry.id
        for name, entry in Manifest(spark, lake_dir, "extract").entries().items()
        if entry.rows is not None
    }
    missing = [name for name, spec in SOURCES.items() if spec.required and name not in landed]
    if missing:
        raise ValueError(f"not landed in {lake_dir}: {', '.join(missing)}")
    manifest = Manifest(spark, lake_dir, "transform")
    if fresh:
        for name in TABLES:
            manifest.drop(name)
    sources = read_lake(spark, lake_dir, landed)
    warehouse = Warehouse(spark, sources, lake_dir, manifest, landed)

    def fact_first() -> None:
        warehouse.mart("fact_payments")
        together(spark, {name: partial(warehouse.mart, name) for name in FROM_FACT})

    alone = [name for name in TABLES if name not in ("fact_payments", *FROM_FACT)]
    together(
        spark,
        {"fact": fact_first, **{name: partial(warehouse.mart, name) for name in alone}},
    )
    return {name: warehouse.rows[name] for name in TABLES}


def load(
    spark: SparkSession,
    lake_dir: str,
    database: str = DATABASE,
    append: bool = False,
    fresh: bool = False,
) -> Rows:
    """Publish the marts that were built; the table of a missing mart is left alone.

    A mart as it was built is one load of its table: loading it again, also with ``append``, changes
    nothing.
    """
    built = Manifest(spark, lake_dir, "transform").entries()
    changed: list[str] = []

    def publish(spec: TableSpec) -> int | None:
        entry = built.get(spec.name)
        if entry is None or entry.rows is None:
            return None
        held = loads_of(spark, spec, database)
        if not fresh and (entry.id in held if append else held == [entry.id]):
            return entry.rows
        path = f"{lake_dir}/transformed/{spec.name}"
        files = partitions_for(size_of(spark, path))
        changed.append(spec.name)
        mart = read_parquet(spark, path)
        return publish_table(spark, mart, spec, database, append, entry.id, files)

    ensure_database(spark, database)
    rows = together(spark, {name: partial(publish, spec) for name, spec in TABLES.items()})
    if any(n is not None for n in rows.values()) and (changed or not shared_folder(spark, database)):
        refresh_shared(spark, database)
    return rows


def run_pipeline(
    spark: SparkSession,
    source_dir: str,
    lake_dir: str,
    database: str = DATABASE,
    multi_line: bool = False,
    fresh: bool = False,
) -> PipelineRun:
    extracted = extract(spark, source_dir, lake_dir, multi_line, fresh)
    transformed = transform(spark, lake_dir, fresh)
    loaded = load(spark, lake_dir, database, fresh=fresh)
    return PipelineRun(spark, database, extracted, transformed, loaded)
