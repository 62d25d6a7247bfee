"""Behaviour of high-value customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.figures import n_rows, percent, total_value
from paylens.functions.labels import high_value
from paylens.functions.time import has_time, quarter
from paylens.plans.tables import ReportTables


def hv_revenue_by_quarter(t: ReportTables) -> DataFrame:
    return (
        t.segment_orders.where(high_value() & has_time())
        .groupBy(quarter().alias("quarter"))
        .agg(total_value("total_payment").alias("hv_revenue"))
        .orderBy("quarter")
    )


def orders_by_quarter(t: ReportTables) -> DataFrame:
    return (
        t.delivered.where(has_time())
        .groupBy(quarter().alias("quarter"))
        .agg(n_rows().alias("total_orders"))
        .orderBy("quarter")
    )


def repeat_rate_by_segment(t: ReportTables) -> DataFrame:
    """Segment rows whose person has more than one delivered order.

    Both sides are counted per person before they meet.
    """
    orders = t.delivered.groupBy("customer_unique_id").agg(n_rows().alias("person_orders"))
    rows, repeat = F.sum("weight"), F.sum(F.when(F.col("person_orders") > 1, F.col("weight")))
    return (
        t.person_segments.join(orders, "customer_unique_id")
        .groupBy("segment")
        .agg(
            F.coalesce(repeat, F.lit(0)).alias("repeat_customers"), rows.alias("total_customers")
        )
        .withColumn(
            "repeat_rate_pct", percent(F.col("repeat_customers"), F.col("total_customers"))
        )
        .orderBy(F.desc("repeat_rate_pct"), "segment")
    )


def _volume(t: ReportTables, name: str) -> DataFrame:
    """All delivered orders, and those of high-value customer ids, by a part of the time."""
    counts = [F.sum(c).alias(c) for c in ("all_orders", "hv_orders")]
    return t.order_times.groupBy(name).agg(*counts).orderBy(name)


def volume_by_weekday(t: ReportTables) -> DataFrame:
    return _volume(t, "day_of_week")


def volume_by_hour(t: ReportTables) -> DataFrame:
    return _volume(t, "hour_of_day")


REPORTS = {
    "q13": hv_revenue_by_quarter,
    "q14": orders_by_quarter,
    "q18": repeat_rate_by_segment,
    "q23a": volume_by_weekday,
    "q23b": volume_by_hour,
}
