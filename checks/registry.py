"""The registered queries: every mart, published table, ingest check and report.

All of them start from the supplied tables. The order fact, the published tables and the
two frames shared by reports are written once per application and data set, into the
folder named by ``spark.checkpoint.dir``, and read back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial, reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.operators import ingest
from paylens.operators.jobs import together
from paylens.operators.publish import (
    conform,
    ensure_database,
    publish_path,
    publish_table,
    write_parquet,
)
from paylens.plans.marts import order_items_products
from paylens.plans.pipeline import PipelineRun, run_pipeline
from paylens.plans.reports import REPORTS
from paylens.plans.reports.geography import regional_opportunity
from paylens.plans.tables import ReportTables
from paylens.plans.warehouse import Warehouse
from paylens.schemas import SOURCES, TABLES
from paylens.session import work_dir
from paylens.sources import testdata
from paylens.sources.catalog import published

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds that spread the states of the supplied data over all three tiers.
TUNED = {"high_revenue": 110_000, "medium_revenue": 90_000, "max_installments": 8}

_Prepared = tuple[dict[str, DataFrame], Warehouse, ReportTables]
_prepared_sets: dict[tuple[str, str], _Prepared] = {}
_lock = Lock()


def _folder(spark: SparkSession, sf_dir: str) -> str:
    return f"{work_dir(spark)}/{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"


def _prepared(spark: SparkSession, sf_dir: str) -> _Prepared:
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _prepared_sets:
            raw = testdata.sources(spark, sf_dir)
            valid = {**raw, "payments": ingest.valid_payments(raw["payments"])}
            built = Warehouse(spark, valid, _folder(spark, sf_dir))
            _prepared_sets[key] = (raw, built, built.report_tables())
        return _prepared_sets[key]


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _prepared(spark, sf_dir)[0]


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return _prepared(spark, sf_dir)[1]


def report_tables(spark: SparkSession, sf_dir: str) -> ReportTables:
    return _prepared(spark, sf_dir)[2]


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: conform(warehouse(spark, sf_dir).plan(name), TABLES[name])


def _published(name: str) -> Query:
    return lambda spark, sf_dir: warehouse(spark, sf_dir).table(name)


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seller rows published, then added once more."""
    name = "seller_orders"
    mart, path = warehouse(spark, sf_dir).mart(name), f"{_folder(spark, sf_dir)}/appended/{name}"
    publish_path(mart, TABLES[name], path)
    publish_path(mart, TABLES[name], path, append=True)
    return spark.read.parquet(path)


def _report(report: Callable[[ReportTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(report_tables(spark, sf_dir))


_numbered: dict[tuple[str, str], DataFrame] = {}


def numbered_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with all their numbers, written once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _numbered:
            path = f"{_folder(spark, sf_dir)}/numbered"
            write_parquet(testdata.sources(spark, sf_dir, all_numbers=True)["payments"], path)
            _numbered[key] = spark.read.parquet(path)
        return _numbered[key]


def _valid_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.valid_payments(numbered_payments(spark, sf_dir))


# A compressed file is read by one task, so files are kept small.
CSV_RECORDS = 1_000_000


def write_csv_sources(spark: SparkSession, sf_dir: str, folder: str, optional: bool = True) -> None:
    """The sources as compressed CSV files, to be read by the pipeline."""

    def write(name: str, df: DataFrame) -> None:
        path = f"{folder}/{SOURCES[name].file}"
        out = df.write.mode("overwrite").option("maxRecordsPerFile", CSV_RECORDS)
        out.csv(path, header=True, compression="gzip")

    sources = testdata.sources(spark, sf_dir, all_numbers=True)
    wanted = {name: df for name, df in sources.items() if optional or SOURCES[name].required}
    together(spark, {name: partial(write, name, df) for name, df in wanted.items()})


def _job(spark: SparkSession, sf_dir: str, optional: bool = True) -> PipelineRun:
    """The whole job from CSV files to catalog tables, run anew."""
    folder = f"{_folder(spark, sf_dir)}/{'job' if optional else 'partial'}"
    write_csv_sources(spark, sf_dir, f"{folder}/csv", optional)
    database = f"paylens_{hashlib.sha256(folder.encode()).hexdigest()[:12]}"
    ensure_database(spark, database, f"{folder}/{database}")
    return run_pipeline(spark, f"{folder}/csv", f"{folder}/lake", database)


_runs: dict[tuple[str, str, bool], PipelineRun] = {}


def finished_job(spark: SparkSession, sf_dir: str, optional: bool = True) -> PipelineRun:
    """The job's last run on this data in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, optional)
    with _lock:
        if key not in _runs:
            _runs[key] = _job(spark, sf_dir, optional)
        return _runs[key]


def _load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded per table by a run of its own."""
    return _job(spark, sf_dir).load_report()


def _job_table(name: str) -> Query:
    return lambda spark, sf_dir: finished_job(spark, sf_dir).tables[name]


def _landed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished_job(spark, sf_dir)
    return spark.read.parquet(f"{_folder(spark, sf_dir)}/job/lake/payments")


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = finished_job(spark, sf_dir).extracted.statuses
    return spark.createDataFrame(list(found.items()), "order_status string, orders bigint")


def _partial_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables that a job without the optional sources has published."""
    tables = finished_job(spark, sf_dir, optional=False).tables
    counts = [
        df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _reloaded(name: str) -> Query:
    """A catalog table, read back after a reload over older rows."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = _catalog(spark, sf_dir)
        mart, spec = warehouse(spark, sf_dir).mart(name), TABLES[name]
        publish_table(spark, mart, spec, database)
        publish_table(spark, mart, spec, database, append=True)
        publish_table(spark, mart, spec, database)
        return published(spark, name, database)

    return query


def _catalog_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, name = f"{_catalog(spark, sf_dir)}_twice", "seller_orders"
    ensure_database(spark, database, f"{_folder(spark, sf_dir)}/{database}")
    mart = warehouse(spark, sf_dir).mart(name)
    publish_table(spark, mart, TABLES[name], database)
    publish_table(spark, mart, TABLES[name], database, append=True)
    return published(spark, name, database)


def _catalog_appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of seller rows, the second one repeated: it is added once."""
    database, name = f"{_catalog(spark, sf_dir)}_once", "seller_orders"
    ensure_database(spark, database, f"{_folder(spark, sf_dir)}/{database}")
    mart = warehouse(spark, sf_dir).mart(name)
    publish_table(spark, mart, TABLES[name], database, load_id="first")
    for _ in range(2):
        publish_table(spark, mart, TABLES[name], database, append=True, load_id="second")
    return published(spark, name, database)


def _catalog(spark: SparkSession, sf_dir: str) -> str:
    folder = _folder(spark, sf_dir)
    database = f"paylens_tables_{hashlib.sha256(folder.encode()).hexdigest()[:12]}"
    ensure_database(spark, database, f"{folder}/{database}")
    return database


_fine: dict[tuple[str, str], Warehouse] = {}


def fine_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over payments with amounts of four decimals."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _fine:
            raw = testdata.sources(spark, sf_dir, fine=True)
            valid = {**raw, "payments": ingest.valid_payments(raw["payments"])}
            _fine[key] = Warehouse(spark, valid, f"{_folder(spark, sf_dir)}/fine")
        return _fine[key]


def _fine_mart(name: str) -> Query:
    return lambda spark, sf_dir: conform(fine_warehouse(spark, sf_dir).plan(name), TABLES[name])


def _fine_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REPORTS["q2"](fine_warehouse(spark, sf_dir).report_tables())


def _untranslated(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_sources(spark, sf_dir)
    mart = order_items_products(raw["items"], raw["products"], None)
    return conform(mart, TABLES["order_items_products"])


FINE = ("fact_payments", "customer_segments", "revenue_by_state")


def registered() -> dict[str, Query]:
    found: dict[str, Query] = {
        "ingest_status_distribution": lambda spark, sf_dir: ingest.status_distribution(
            raw_sources(spark, sf_dir)["orders"]
        ),
        "ingest_valid_payments": _valid_payments,
        "ingest_counts": lambda spark, sf_dir: ingest.source_counts(raw_sources(spark, sf_dir)),
        "publish_seller_orders_appended": _appended,
        "job_load_report": _load_report,
        "job_landed_payments": _landed_payments,
        "job_ingest_counts": lambda spark, sf_dir: finished_job(spark, sf_dir).ingest_report(),
        "job_ingest_statuses": _statuses,
        "job_partial_tables": _partial_tables,
        "job_partial_revenue_by_state": lambda spark, sf_dir: finished_job(
            spark, sf_dir, optional=False
        ).tables["revenue_by_state"],
        "mart_order_items_products_untranslated": _untranslated,
        "publish_table_seller_orders_appended": _catalog_appended,
        "publish_table_seller_orders_appended_once": _catalog_appended_once,
        "report_q2_fine": _fine_q2,
        "report_q17_5_tuned": _report(lambda t: regional_opportunity(t, **TUNED)),
    }
    for name in TABLES:
        found[f"mart_{name}"] = _mart(name)
        found[f"publish_{name}_normalized"] = _published(name)
        found[f"publish_table_{name}"] = _reloaded(name)
        found[f"job_table_{name}"] = _job_table(name)
    for name in FINE:
        found[f"mart_{name}_fine"] = _fine_mart(name)
    for key, report in REPORTS.items():
        found[f"report_{key}"] = _report(report)
    return found
