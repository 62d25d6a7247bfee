"""Executive summary."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens import constants as C
from paylens.functions.figures import amount, n_rows, percent, running_total, total, total_value
from paylens.functions.labels import binned, high_value
from paylens.functions.time import has_time, month
from paylens.plans.tables import ReportTables


def spending_distribution(t: ReportTables) -> DataFrame:
    bins = t.spending_bins.select("spending_bin", "customer_count")
    return bins.orderBy("spending_bin").limit(C.SPENDING_BINS_SHOWN)


def spending_table(t: ReportTables) -> DataFrame:
    """The windows run over the bins of a slice, and over the slices."""
    bins = running_total(t.spending_bins, "customer_count", "spending_bin", "slice")
    return bins.select(
        "spending_bin",
        "customer_count",
        percent(F.col("customer_count"), F.col("whole")).alias("pct_customers"),
        percent(F.col("so_far"), F.col("whole")).alias("cumulative_pct"),
    ).orderBy("spending_bin")


def order_value_histogram(t: ReportTables) -> DataFrame:
    return (
        t.delivered.groupBy(binned(F.col("total_payment"), C.ORDER_VALUE_BINS).alias("value_bin"))
        .agg(n_rows().alias("total_orders"), F.min("total_payment").alias("smallest"))
        .orderBy("smallest")
        .drop("smallest")
    )


def total_orders(t: ReportTables) -> DataFrame:
    return t.delivered.agg(n_rows().alias("total_orders"))


def revenue_vs_target(t: ReportTables) -> DataFrame:
    actual = F.coalesce(total("total_payment"), F.lit(0))
    target = F.round(actual * F.lit(Decimal(C.TARGET_FACTOR)), 2)
    return t.delivered.agg(
        amount(actual).alias("actual_revenue"), amount(target).alias("target_revenue")
    )


def composition_by_segment(t: ReportTables) -> DataFrame:
    return (
        t.segments.groupBy("segment")
        .agg(n_rows().alias("total_orders"))
        .orderBy(F.desc("total_orders"), "segment")
    )


def revenue_by_segment(t: ReportTables) -> DataFrame:
    return (
        t.segment_orders.groupBy("segment")
        .agg(total_value("total_payment").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "segment")
    )


def monthly_hv_revenue(t: ReportTables) -> DataFrame:
    return (
        t.segment_orders.where(high_value() & has_time())
        .groupBy(month().alias("month"))
        .agg(total_value("total_payment").alias("hv_revenue"))
        .orderBy("month")
    )


REPORTS = {
    "q0a": spending_distribution,
    "q0b": spending_table,
    "q19": order_value_histogram,
    "q12": total_orders,
    "q11": revenue_vs_target,
    "q1": composition_by_segment,
    "q2": revenue_by_segment,
    "q10": monthly_hv_revenue,
}
