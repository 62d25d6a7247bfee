"""Totals that must agree across marts and reports of the supplied data."""

from __future__ import annotations

import math
import os

from pyspark.sql import functions as F

from paylens.plans.reports import REPORTS
from paylens.sources import testdata
from tests.conftest import SF_DIR


def summed(df, column):
    return round(math.fsum(r[column] for r in df.select(column).collect()), 2)


def test_revenue_agrees_everywhere(supplied, reports):
    actual = REPORTS["q11"](reports).first().actual_revenue
    for name, column in (
        ("revenue_by_state", "total_revenue"),
        ("installment_analysis", "total_revenue"),
        ("payment_method_analysis", "total_revenue"),
        ("customer_segments", "total_spent"),
    ):
        assert summed(supplied.table(name), column) == actual
    assert summed(REPORTS["q2"](reports), "total_revenue") == actual
    assert REPORTS["q7"](reports).where("label = 'Total Revenue'").first().value == actual


def test_orders_agree_everywhere(supplied, reports):
    orders = REPORTS["q12"](reports).first().total_orders
    for name in ("revenue_by_state", "installment_analysis", "payment_method_analysis"):
        assert sum(r.total_orders for r in supplied.table(name).collect()) == orders
    for key in ("q1", "q9", "q19", "b2", "b3"):
        assert sum(r.total_orders for r in REPORTS[key](reports).collect()) == orders


def test_fact_is_unique_per_order_and_leakage_is_its_part(supplied):
    fact = supplied.table("fact_payments")
    assert fact.count() == fact.select("order_id").distinct().count() == 1471
    lost = fact.where(F.col("order_status").isin("canceled", "unavailable"))
    assert supplied.table("revenue_leakage").count() == lost.count() == 189
    assert supplied.table("customer_segments").count() == 1185


def test_every_item_is_kept(supplied):
    assert supplied.table("order_items_products").count() == supplied.sources["items"].count()


def test_shares_add_up(reports):
    for key, column in (
        ("q0b", "pct_customers"),
        ("q3_5", "revenue_pct"),
        ("q8_5", "pct_of_total_lost"),
    ):
        shares = [r[column] for r in REPORTS[key](reports).collect()]
        assert abs(sum(shares) - 100) <= 0.01 * len(shares)


def test_first_bins_of_the_table(reports):
    table = REPORTS["q0b"](reports).select("spending_bin", "customer_count").collect()
    assert REPORTS["q0a"](reports).collect() == table[:20]


def test_numbering_in_slices_equals_one_window(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    one = lines.withColumn("l_orderkey", F.lit(1))
    for some in (lines, one, one.withColumns({"l_partkey": F.lit(1), "l_linenumber": F.lit(1)})):
        whole = testdata.payments(some).na.fill("").collect()
        sliced = testdata.numbered_payments(some).na.fill("").collect()
        assert sorted(sliced) == sorted(whole)


def test_one_order_and_part_is_numbered_in_many_tasks(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    hot = lines.withColumns({c: F.lit(1) for c in ("l_orderkey", "l_partkey", "l_linenumber")})
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # small partitions are merged
    spark.conf.set(merge, "false")
    try:
        numbered = testdata.numbered_payments(hot)
    finally:
        spark.conf.unset(merge)
    assert numbered.agg(F.max("payment_sequential")).first()[0] == lines.count()
    folders = {os.path.dirname(f) for f in numbered.inputFiles()}
    stored = spark.read.parquet(*folders)
    sizes = [r["count"] for r in stored.groupBy("slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * lines.count()
