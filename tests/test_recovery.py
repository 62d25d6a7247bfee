"""Loads and stages that fail or are killed half-way, and what a second run does."""

from __future__ import annotations

import os

import pytest

from paylens.operators import folders, ingest, manifest, publish
from paylens.operators.publish import loads_of, publish_table, write_parquet
from paylens.plans import pipeline, warehouse
from paylens.plans.pipeline import extract, load, run_pipeline, transform
from paylens.schemas import SOURCES, TABLES, TableSpec
from paylens.sources.catalog import location, published, version_of
from tests.test_publish import content, csv_dir  # noqa: F401

ROWS = TABLES["installment_analysis"]
WIDE = "max_installments bigint, avg_order_value double, total_orders bigint, total_revenue double"


def mart(spark, *numbers):
    return spark.createDataFrame([(n, 1.0, n, 2.0) for n in numbers], WIDE)


def loaded(spark, database):
    return sorted(r.max_installments for r in published(spark, ROWS.name, database).collect())


class Killed(BaseException):
    """Ends the work as a kill does: nothing after it runs but what a new process starts."""


def kill(*_, **__):
    raise Killed


@pytest.mark.parametrize("append", [False, True])
def test_a_load_that_fails_on_a_row_changes_nothing(spark, append):
    database = f"failing_{append}"
    publish_table(spark, mart(spark, 1, 2, 3), ROWS, database)
    bad = mart(spark, *range(100), 3_000_000_000).coalesce(1)
    with pytest.raises(Exception, match="OVERFLOW"):
        publish_table(spark, bad, ROWS, database, append)
    assert loaded(spark, database) == [1, 2, 3]
    assert publish_table(spark, mart(spark, 9), ROWS, database, append) == 1
    assert loaded(spark, database) == ([1, 2, 3, 9] if append else [9])


@pytest.mark.parametrize("step", ["rename", "move_to"])
def test_a_reload_killed_half_way_leaves_the_rows_of_before(spark, monkeypatch, step):
    database = f"killed_{step}"
    publish_table(spark, mart(spark, 1, 2), ROWS, database, load_id="a")
    with monkeypatch.context() as patch:
        owner = folders.Files if step == "rename" else publish
        patch.setattr(owner, step, kill)
        with pytest.raises(Killed):
            publish_table(spark, mart(spark, 7), ROWS, database, load_id="b")
    assert loaded(spark, database) == [1, 2] and loads_of(spark, ROWS, database) == ["a"]
    for n in (7, 8, 9):
        publish_table(spark, mart(spark, n), ROWS, database, load_id=f"b{n}")
    assert loaded(spark, database) == [9]
    versions = os.listdir(f"{location(spark, database)}/versions/{ROWS.name}".removeprefix("file:"))
    assert len(versions) == 2  # the present one and the one that queries may still read


def test_a_repeated_append_adds_nothing(spark, monkeypatch):
    publish_table(spark, mart(spark, 1), ROWS, "twice", load_id="a")
    add = dict(append=True, load_id="b")
    with monkeypatch.context() as patch:  # killed after the rows were written
        patch.setattr(folders.Files, "rename", kill)
        with pytest.raises(Killed):
            publish_table(spark, mart(spark, 2, 3), ROWS, "twice", **add)
    assert loaded(spark, "twice") == [1]
    for _ in range(3):
        assert publish_table(spark, mart(spark, 2, 3), ROWS, "twice", **add) == 2
        assert loaded(spark, "twice") == [1, 2, 3]
    assert sorted(loads_of(spark, ROWS, "twice")) == ["a", "b"]


@pytest.mark.parametrize("append", [False, True])
def test_a_table_made_by_other_means(spark, append):
    database = f"foreign_{append}"
    spark.sql(f"CREATE DATABASE {database}")
    spark.sql(f"CREATE TABLE {database}.{ROWS.name} ({ROWS.ddl}) USING parquet")
    spark.sql(f"INSERT INTO {database}.{ROWS.name} VALUES (5, 1D, 1L, 1D)")
    assert publish_table(spark, mart(spark, 6), ROWS, database, append) == 1
    assert loaded(spark, database) == ([5, 6] if append else [6])
    assert version_of(spark, ROWS.name, database)


def test_a_folder_is_replaced_when_the_new_one_is_complete(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "mart")
    write_parquet(spark.range(5), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_parquet(spark.range(9).selectExpr("1 DIV (id - 8) AS id"), path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["mart"]
    renames = []

    def second_fails(self, old, new, rename=folders.Files.rename):
        if len(renames) == 1:
            raise Killed
        renames.append(old)
        rename(self, old, new)

    with monkeypatch.context() as patch:  # the old folder is away, the new one not yet there
        patch.setattr(folders.Files, "rename", second_fails)
        patch.setattr(folders.Files, "delete", lambda *_: None)
        with pytest.raises(Killed):
            write_parquet(spark.range(7), path)
    assert not os.path.exists(path)
    folders.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    write_parquet(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7


def written(monkeypatch):
    """The names of the folders that are written from now on."""
    found = []
    write = write_parquet

    def note(df, path, *args, **kwargs):
        found.append(os.path.basename(path))
        return write(df, path, *args, **kwargs)

    for module in (ingest, warehouse):
        monkeypatch.setattr(module, "write_parquet", note)
    return found


def test_a_killed_transform_goes_on_where_it_ended(spark, csv_dir, tmp_path, monkeypatch):  # noqa: F811
    lake = str(tmp_path)
    extract(spark, str(csv_dir), lake)
    complete = []

    def ends(self, name, entry, put=manifest.Manifest.put):
        if len(complete) == 3:
            raise Killed
        complete.append(name)
        return put(self, name, entry)

    with monkeypatch.context() as patch:
        patch.setattr(manifest.Manifest, "put", ends)
        with pytest.raises(Killed):
            transform(spark, lake)
    again = written(monkeypatch)
    rows = transform(spark, lake)
    assert sorted(again) == sorted(set(TABLES) - set(complete)) and len(complete) == 3
    assert all(n is not None for n in rows.values())
    again.clear()
    assert transform(spark, lake) == rows and not again
    assert transform(spark, lake, fresh=True) == rows and sorted(again) == sorted(TABLES)


def test_only_what_a_changed_source_reaches_is_made_again(spark, csv_dir, tmp_path, monkeypatch):  # noqa: F811
    source, lake = tmp_path / "csv", str(tmp_path / "lake")
    source.mkdir()
    for spec in SOURCES.values():
        (source / spec.file).symlink_to(csv_dir / spec.file)
    first = run_pipeline(spark, str(source), lake, "resumed")
    before = {name: content(df) for name, df in first.tables.items()}
    again = written(monkeypatch)
    second = run_pipeline(spark, str(source), lake, "resumed")
    assert not again and (second.landed, second.transformed, second.loaded) == (
        first.landed, first.transformed, first.loaded,
    )
    assert second.extracted.statuses == first.extracted.statuses
    sellers = source / SOURCES["sellers"].file
    kept = spark.read.csv(str(sellers), header=True).limit(3).toPandas()
    sellers.unlink()
    kept.to_csv(sellers, index=False)
    third = run_pipeline(spark, str(source), lake, "resumed")
    assert again == ["sellers", "seller_orders"] and third.loaded["seller_orders"] <= 3
    for name in set(TABLES) - {"seller_orders"}:
        assert content(third.tables[name]) == before[name]


def test_a_load_repeated_with_append_changes_nothing(spark, csv_dir, tmp_path):  # noqa: F811
    lake = str(tmp_path)
    run = run_pipeline(spark, str(csv_dir), lake, "appending")
    assert load(spark, lake, "appending", append=True) == run.loaded
    transform(spark, lake, fresh=True)  # the same rows, but another load
    for _ in range(2):
        load(spark, lake, "appending", append=True)
        for name, table in run.tables.items():
            assert table.count() == 2 * run.loaded[name]
            assert len(loads_of(spark, TABLES[name], "appending")) == 2


def test_transform_needs_the_required_sources(spark, tmp_path):
    with pytest.raises(ValueError, match="not landed.*orders"):
        transform(spark, str(tmp_path))


def test_statuses_are_counted_while_landing(spark, tmp_path, monkeypatch):
    names = [f"s{i % 700}" for i in range(5000)] + ["often"] * 900 + [None] * 9
    orders = spark.createDataFrame([(str(i), s) for i, s in enumerate(names)], "order_id string, order_status string")
    expected = {r.order_status: r.orders for r in ingest.status_distribution(orders).collect()}
    with monkeypatch.context() as patch:  # no second job
        patch.setattr(ingest, "status_distribution", kill)
        found = ingest.land(orders.repartition(5), SOURCES["orders"], str(tmp_path / "a"))
    assert list(found.statuses.items()) == list(expected.items())
    monkeypatch.setattr(ingest, "MOST_STATUSES", 500)  # more statuses than are counted on the way
    found = ingest.land(orders.repartition(5), SOURCES["orders"], str(tmp_path / "b"))
    assert list(found.statuses.items()) == list(expected.items())
    monkeypatch.setattr(ingest, "MOST_STATUSES", 100)
    monkeypatch.setattr(ingest, "HELD_STATUSES", 300)  # some were dropped to make room
    found = ingest.land(orders.repartition(5), SOURCES["orders"], str(tmp_path / "c"))
    assert list(found.statuses.items()) == list(expected.items())


def ranges(spark, version):
    """Least and greatest key of every file below a version's folder."""
    import pyarrow.parquet as pq

    found = []
    for folder, _, names in os.walk(version.removeprefix("file:")):
        for name in names:
            if name.endswith(".parquet"):
                keys = pq.read_table(f"{folder}/{name}")["k"].to_pylist()
                if keys:
                    assert keys == sorted(keys)
                    found.append((keys[0], keys[-1], len(keys)))
    return sorted(found)


def test_files_of_a_table_hold_ranges_of_the_key(spark):
    spec = TableSpec("ranged", {"k": "bigint", "v": "bigint"}, "k")
    df = spark.range(40_000).selectExpr("(id * 7919) % 40000 AS k", "id AS v").repartition(5)
    publish_table(spark, df, spec, "ranged", files=8)
    found = ranges(spark, version_of(spark, "ranged", "ranged"))
    assert len(found) == 8 and sum(n for *_, n in found) == 40_000
    assert all(a[1] < b[0] for a, b in zip(found, found[1:]))
    assert max(n for *_, n in found) < 2 * min(n for *_, n in found)


def test_a_frequent_key_is_spread_over_files(spark):
    spec = TableSpec("spread", {"k": "bigint", "v": "bigint"}, "k")
    df = spark.range(40_000).selectExpr("if(id % 3 = 0, 5, id) AS k", "id AS v")
    publish_table(spark, df, spec, "spread", files=8)
    found = ranges(spark, version_of(spark, "spread", "spread"))
    assert max(n for *_, n in found) < 10_000
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    for key in (40, 20_000, 39_998):
        assert sum(low <= key <= high for low, high, _ in found) <= 2
