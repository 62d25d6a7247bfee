"""Publishing into catalog tables and folders; the whole job."""

from __future__ import annotations

from threading import Event

import pytest

from paylens.__main__ import main
from paylens.operators.publish import ensure_database, normalise, publish_path, publish_table
from paylens.plans.pipeline import extract, load, run_pipeline, transform
from paylens.plans.reports import REPORTS
from paylens.plans.tables import ReportTables
from paylens.plans.warehouse import Warehouse
from paylens.schemas import SOURCES, TABLES
from paylens.session import work_dir
from paylens.sources.catalog import list_published, location, published

METHODS = TABLES["payment_method_analysis"]
SCHEMA = (
    "extra int, total_orders bigint, payment_type string, total_revenue decimal(28,2), "
    "avg_order_value double, avg_installments double"
)


def methods(spark, *rows):
    return spark.createDataFrame([(1, n, kind, None, None, 2.0) for kind, n in rows], SCHEMA)


def test_normalise_fills_and_orders_columns(spark):
    df = normalise(methods(spark, (None, None), ("voucher", 3)), METHODS)
    assert dict(df.dtypes) == METHODS.columns and df.columns == list(METHODS.columns)
    assert sorted(tuple(r) for r in df.collect()) == [
        ("", 0, 0.0, 0.0, 2.0),
        ("voucher", 3, 0.0, 0.0, 2.0),
    ]


def test_nan_becomes_zero(spark):
    df = spark.createDataFrame([(float("nan"),)], "avg_order_value double")
    spec = type(METHODS)("t", {"avg_order_value": "double"}, "avg_order_value")
    assert normalise(df, spec).first().avg_order_value == 0.0


def test_narrowing_overflow_raises(spark):
    df = spark.createDataFrame([(2**31,)], "max_installments bigint")
    spec = type(METHODS)("t", {"max_installments": "int"}, "max_installments")
    with pytest.raises(Exception, match="OVERFLOW"):
        normalise(df, spec).collect()


def test_publish_replaces_appends_and_skips(spark):
    def loaded():
        table = published(spark, METHODS.name, "pub")
        return sorted((r.payment_type, r.total_orders) for r in table.collect())

    ensure_database(spark, "pub")
    ensure_database(spark, "pub")
    assert publish_table(spark, methods(spark, ("a", 1), ("b", 2)), METHODS, "pub") == 2
    assert publish_table(spark, methods(spark, ("a", 1), ("b", 2)), METHODS, "pub") == 2
    assert loaded() == [("a", 1), ("b", 2)]
    assert publish_table(spark, methods(spark, ("c", 3)), METHODS, "pub") == 1
    assert loaded() == [("c", 3)]
    assert publish_table(spark, None, METHODS, "pub") is None
    assert loaded() == [("c", 3)]
    assert publish_table(spark, methods(spark, ("d", 4)), METHODS, "pub", append=True) == 1
    assert loaded() == [("c", 3), ("d", 4)]
    assert publish_table(spark, methods(spark), METHODS, "pub") == 0
    assert loaded() == []
    assert list_published(spark, "pub") == [METHODS.name]


def test_publish_path_sorts_inside_files(spark, tmp_path):
    spec = TABLES["installment_analysis"]
    df = spark.range(1000).selectExpr(
        "int((id * 7919) % 1000) AS max_installments", "1D AS avg_order_value",
        "1L AS total_orders", "1D AS total_revenue",
    ).repartition(3)
    assert publish_path(df, spec, str(tmp_path / "t")) == 1000
    for file in sorted((tmp_path / "t").glob("*.parquet")):
        keys = [r.max_installments for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)


@pytest.fixture(scope="module")
def csv_dir(spark, tmp_path_factory):
    from checks.registry import write_csv_sources
    from tests.conftest import SF_DIR

    folder = tmp_path_factory.mktemp("csv")
    write_csv_sources(spark, SF_DIR, str(folder))
    return folder


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pipeline_round_trip(spark, csv_dir, tmp_path, supplied):
    ensure_database(spark, "full", str(tmp_path / "db"))
    run = run_pipeline(spark, str(csv_dir), str(tmp_path), "full")
    assert list_published(spark, "full") == sorted(TABLES)
    assert run.landed["orders"] == 1500 and run.landed["payments"] < run.landed["items"] == 6000
    for name in TABLES:
        assert run.tables[name].dtypes == list(TABLES[name].columns.items())
        assert content(run.tables[name]) == content(supplied.table(name))
        assert run.loaded[name] == run.tables[name].count()
    assert {r.table: r.rows for r in run.load_report().collect()} == run.loaded

    first = {name: content(df) for name, df in run.tables.items()}
    again = run_pipeline(spark, str(csv_dir), str(tmp_path), "full")
    assert {name: content(df) for name, df in again.tables.items()} == first

    stored = run.report_tables()
    plain = ReportTables(run.tables.__getitem__)
    for key in ("q2", "q3_5", "q17_5", "q23a"):
        assert content(REPORTS[key](stored)) == content(REPORTS[key](plain))
    place = location(spark, "full").removeprefix("file:")
    assert place in stored.segment_orders.inputFiles()[0]
    assert len(list((tmp_path / "db").glob("shared_*"))) == 1  # the first run's were removed

    # a table that is published by itself makes the stored frames outdated
    publish_table(spark, supplied.mart("customer_segments"), TABLES["customer_segments"], "full")
    alone = run.report_tables()
    assert work_dir(spark) in alone.segment_orders.inputFiles()[0]
    assert content(REPORTS["q2"](alone)) == content(REPORTS["q2"](plain))


def test_pipeline_without_optional_sources(spark, csv_dir, tmp_path):
    optional = [s.name for s in SOURCES.values() if not s.required]
    source = tmp_path / "csv"
    source.mkdir()
    for spec in SOURCES.values():
        if spec.required:
            (source / spec.file).symlink_to(csv_dir / spec.file)
    run = run_pipeline(spark, str(source), str(tmp_path / "lake"), "partial")
    assert [name for name, n in run.landed.items() if n is None] == optional
    assert run.loaded["order_items_products"] is None and run.loaded["seller_orders"] is None
    assert set(TABLES) - set(run.tables) == {"order_items_products", "seller_orders"}
    assert run.loaded["fact_payments"] == 1471

    # products without translations: native names
    (source / SOURCES["products"].file).symlink_to(csv_dir / SOURCES["products"].file)
    run = run_pipeline(spark, str(source), str(tmp_path / "lake"), "partial")
    names = {r.category for r in run.tables["order_items_products"].collect()}
    assert names and not any(name.startswith("en_") for name in names)

    # a table published earlier stays when there is no mart for it
    assert load(spark, str(tmp_path / "none"), "partial") == dict.fromkeys(TABLES)
    assert run.tables["order_items_products"].count() == 6000


def test_rerun_without_optional_sources_on_a_used_lake(spark, csv_dir, tmp_path):
    """Files of the first run are still there, but they are not taken for the second one's."""
    lake, source = str(tmp_path / "lake"), tmp_path / "csv"
    first = run_pipeline(spark, str(csv_dir), lake, "used")
    before = content(first.tables["order_items_products"])
    source.mkdir()
    for spec in SOURCES.values():
        if spec.required:
            (source / spec.file).symlink_to(csv_dir / spec.file)
    run = run_pipeline(spark, str(source), lake, "used")
    for name in ("order_items_products", "seller_orders"):
        assert run.transformed[name] is None and run.loaded[name] is None
    assert run.loaded["fact_payments"] == first.loaded["fact_payments"]
    assert content(run.tables["order_items_products"]) == before


def test_marts_without_the_fact_run_beside_it(spark, csv_dir, tmp_path, monkeypatch):
    lake = str(tmp_path)
    extract(spark, str(csv_dir), lake)
    written = {name: Event() for name in ("order_items_products", "seller_orders")}
    mart = Warehouse.mart

    def slow_fact(self, name):
        if name == "fact_payments" and name not in self.rows:
            assert all(done.wait(120) for done in written.values())
        result = mart(self, name)
        if name in written:
            written[name].set()
        return result

    monkeypatch.setattr(Warehouse, "mart", slow_fact)
    assert transform(spark, lake)["fact_payments"] == 1471


def test_report_of_the_ingest(spark, csv_dir, tmp_path, duck):
    from checks import oracle

    found = extract(spark, str(csv_dir), str(tmp_path))
    counts = duck.execute(oracle.statements()["ingest_counts"]).fetchall()
    assert {(n, x.rows_read, x.rows_kept) for n, x in found.sources.items()} == set(counts)
    statuses = duck.execute(oracle.statements()["ingest_status_distribution"]).fetchall()
    assert found.statuses == dict(statuses)


def test_table_with_other_columns_is_left_alone(spark):
    """Columns are inserted by position, so another order would swap values."""
    ensure_database(spark, "swapped")
    spec = TABLES["seller_orders"]
    columns = dict(reversed(spec.columns.items()))
    ddl = ", ".join(f"{c} {t}" for c, t in columns.items())
    spark.sql(f"CREATE TABLE swapped.seller_orders ({ddl}) USING parquet")
    spark.sql("INSERT INTO swapped.seller_orders VALUES (1.0, 2, 3, 'SP', 'x')")
    mart = spark.createDataFrame([("s", "SP", 5, 1, 20.0)], spec.ddl)
    for append in (False, True):
        with pytest.raises(ValueError, match="has columns"):
            publish_table(spark, mart, spec, "swapped", append)
    assert [r.seller_id for r in published(spark, "seller_orders", "swapped").collect()] == ["x"]


def test_stages_can_run_alone(spark, csv_dir, tmp_path, capsys):
    lake = str(tmp_path)
    common = ["--source", str(csv_dir), "--lake", lake, "--database", "staged"]
    first = main([*common, "--stages", "extract", "transform"])
    assert list(first) == ["extract", "transform"]
    assert not spark.catalog.databaseExists("staged")
    assert main([*common, "--stages", "load"])["load"] == first["transform"]
    assert list_published(spark, "staged") == sorted(TABLES)
    printed = capsys.readouterr().out
    assert "load customer_segments: 1185" in printed
    assert "read orders: 1500, kept 1500" in printed and "status delivered: " in printed
