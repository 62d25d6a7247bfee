"""Payment behaviour and preferences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens import constants as C
from paylens.functions.figures import amount, exact, mean_value, n_rows, percent
from paylens.functions.labels import high_value, paid_by, single_installment
from paylens.plans.tables import ReportTables


def methods_by_segment(t: ReportTables) -> DataFrame:
    return (
        t.segment_orders.groupBy("segment")
        .agg(*[F.count_if(paid_by(kind)).alias(kind) for kind in C.PAYMENT_TYPES])
        .orderBy("segment")
    )


def premium_payment_mix(t: ReportTables) -> DataFrame:
    """Orders of persons with Premium rows; an order's amount counts once per such row."""
    premium = t.person_segments.where(F.col("segment") == C.PREMIUM)
    weighted = exact("total_payment") * F.col("weight").cast("decimal(19,0)")
    revenue = F.col("revenue")
    whole = F.sum(revenue).over(Window.partitionBy("segment"))
    return (
        t.delivered.join(premium, "customer_unique_id")
        .groupBy("segment", "payment_type")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum(weighted).alias("revenue"),
        )
        .select(
            "segment",
            "payment_type",
            "total_orders",
            amount(revenue).alias("total_revenue"),
            percent(revenue, whole).alias("revenue_pct"),
        )
        .orderBy("segment", F.desc("total_revenue"), "payment_type")
    )


def hv_card_installments(t: ReportTables) -> DataFrame:
    return (
        t.segment_orders.where(high_value() & paid_by(C.CREDIT_CARD))
        .groupBy("max_installments")
        .agg(n_rows().alias("total_orders"))
        .orderBy("max_installments")
    )


def single_vs_installment(t: ReportTables) -> DataFrame:
    group = F.when(single_installment(), C.SINGLE_PAYMENT).otherwise(C.INSTALLMENT)
    return _value_and_orders(t, group.alias("installment_group"))


def voucher_order_value(t: ReportTables) -> DataFrame:
    group = F.when(paid_by(C.VOUCHER), C.WITH_VOUCHER).otherwise(C.WITHOUT_VOUCHER)
    return _value_and_orders(t, group.alias("voucher_group"))


def _value_and_orders(t: ReportTables, group) -> DataFrame:
    grouped = t.delivered.groupBy(group).agg(
        mean_value("total_payment").alias("avg_order_value"), n_rows().alias("total_orders")
    )
    return grouped.orderBy(F.desc("avg_order_value"), grouped.columns[0])


def card_installments_vs_value(t: ReportTables) -> DataFrame:
    return (
        t.delivered.where(paid_by(C.CREDIT_CARD) & F.col("max_installments").between(1, 10))
        .groupBy("max_installments")
        .agg(mean_value("total_payment").alias("avg_order_value"), n_rows().alias("total_orders"))
        .orderBy("max_installments")
    )


def voucher_repeat_rate(t: ReportTables) -> DataFrame:
    persons = t.delivered.groupBy("customer_unique_id").agg(
        F.bool_or(paid_by(C.VOUCHER)).alias("used_voucher"),
        F.count_distinct("order_id").alias("orders"),
    )
    user = F.when(F.col("used_voucher"), C.VOUCHER_USER).otherwise(C.NON_VOUCHER)
    repeat = F.count_if(F.col("orders") > 1)
    return (
        persons.groupBy(user.alias("voucher_user"))
        .agg(
            repeat.alias("repeat_customers"),
            n_rows().alias("total_customers"),
            percent(repeat, n_rows()).alias("repeat_rate_pct"),
        )
        .orderBy(F.desc("repeat_rate_pct"), "voucher_user")
    )


def voucher_share_by_segment(t: ReportTables) -> DataFrame:
    vouchers = F.count_if(paid_by(C.VOUCHER))
    return (
        t.segment_orders.groupBy("segment")
        .agg(
            vouchers.alias("voucher_orders"),
            n_rows().alias("total_orders"),
            percent(vouchers, n_rows()).alias("voucher_pct"),
        )
        .orderBy(F.desc("voucher_pct"), "segment")
    )


REPORTS = {
    "q3": methods_by_segment,
    "q3_5": premium_payment_mix,
    "q4": hv_card_installments,
    "q9": single_vs_installment,
    "q16": card_installments_vs_value,
    "b1": voucher_repeat_rate,
    "b2": voucher_order_value,
    "b3": voucher_share_by_segment,
}
