from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("paylens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def supplied(spark):
    """The warehouse of the smallest supplied data set."""
    from checks.registry import warehouse

    return warehouse(spark, SF_DIR)


@pytest.fixture(scope="session")
def reports(spark):
    from checks.registry import report_tables

    return report_tables(spark, SF_DIR)


@pytest.fixture
def tables(spark):
    """Build report tables from lists of rows, published with the fixed schemas."""
    from paylens.operators.publish import normalise
    from paylens.plans.tables import ReportTables
    from paylens.schemas import TABLES as SPECS

    def build(**rows):
        frames = {}
        for name, spec in SPECS.items():
            given = [tuple(r.get(c) for c in spec.columns) for r in rows.get(name, [])]
            frames[name] = normalise(spark.createDataFrame(given, spec.ddl), spec)
        return ReportTables(frames.__getitem__)

    return build


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
