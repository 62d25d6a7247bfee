"""Payments of all numbers: rows moved once, large orders in slices, compressed sources."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import registry
from paylens.sources import testdata

LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp"
)


@pytest.fixture
def lines(spark):
    """Line items of the given orders."""

    def build(*orders):
        draw, day = random.Random(5), datetime(1995, 1, 1)
        rows = [
            (key, i, draw.randint(1, 9), draw.randint(1, 7), float(draw.randint(1, 50)),
             draw.randint(100, 99_999) / 100, 0.05, 0.02, draw.choice("ANR"), draw.choice("FO"),
             day + timedelta(days=draw.randint(0, 900)))
            for i, key in enumerate(orders)
        ]
        return spark.createDataFrame(rows, LINES).repartition(3)

    return build


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(df.na.fill("").collect())


def test_rows_of_usual_orders_are_moved_once(lines):
    some = lines(*[key for key in range(300) for _ in range(4)])
    given = some.sparkSession.createDataFrame(some.collect(), LINES)
    text = plan(testdata.numbered_payments(given))
    (moved,) = [line for line in text.splitlines() if "Exchange" in line]
    assert "hashpartitioning(l_orderkey" in moved
    assert "l_tax" not in text.split("Exchange")[0] and "RangePartitioning" not in text


def test_large_and_usual_orders_are_numbered_like_in_one_window(lines, monkeypatch):
    monkeypatch.setattr(testdata, "LARGE_ORDER", 100)
    some = lines(*[7] * 400, *[8] * 150, *[key for key in range(20, 120) for _ in range(3)]).cache()
    assert sorted(testdata._large_orders(some)) == [7, 8]
    assert rows_of(testdata.numbered_payments(some)) == rows_of(testdata.payments(some))
    some.unpersist()


def test_no_order_is_large_without_rows(lines):
    none = lines(1).where(F.col("l_orderkey") > 1)
    assert testdata._large_orders(none) == [] and rows_of(testdata.numbered_payments(none)) == []


def test_an_order_over_its_part_of_the_rows_is_never_missed(spark):
    """More orders than are held, and one with a little more than the part of all rows."""
    n = 60_000
    keys = spark.range(n).select(F.col("id").alias("l_orderkey"))
    hot = spark.range(1_200).select(F.lit(-5).cast("bigint").alias("l_orderkey"))
    assert testdata._large_orders(keys.unionByName(hot).repartition(4)) == [-5]


def test_sources_are_written_compressed_and_in_small_files(spark, lines, tmp_path, monkeypatch):
    some = lines(*range(50))
    made = {"items": testdata.items(some), "payments": testdata.numbered_payments(some)}
    monkeypatch.setattr(testdata, "sources", lambda *args, **options: made)
    monkeypatch.setattr(registry, "CSV_RECORDS", 10)
    registry.write_csv_sources(spark, "", str(tmp_path))
    for name, df in made.items():
        path = tmp_path / registry.SOURCES[name].file
        files = list(Path(path).glob("part-*"))
        assert len(files) >= 5 and all(f.name.endswith(".csv.gz") for f in files)
        back = spark.read.csv(str(path), header=True)
        assert back.count() == df.count() and back.columns == df.columns
