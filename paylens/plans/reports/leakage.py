"""Revenue leakage and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens import constants as C
from paylens.functions.figures import (
    amount,
    mean,
    mean_value,
    n_rows,
    percent,
    round2,
    total,
    total_value,
)
from paylens.functions.labels import (
    binned,
    canceled,
    high_value,
    near_threshold,
    paid_by,
    single_installment,
)
from paylens.plans.tables import ReportTables


def _voucher_canceled(t: ReportTables) -> DataFrame:
    return t.leakage.where(paid_by(C.VOUCHER) & canceled())


def revenue_at_risk(t: ReportTables) -> DataFrame:
    return t.leakage.agg(total_value("total_payment").alias("total_revenue_at_risk"))


def voucher_at_risk(t: ReportTables) -> DataFrame:
    def value(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.lit(label).alias("label"), total_value("total_payment").alias("value"))

    return value(_voucher_canceled(t), "Voucher at Risk").unionByName(
        value(t.delivered, "Total Revenue")
    )


def voucher_canceled_value(t: ReportTables) -> DataFrame:
    return _voucher_canceled(t).agg(total_value("total_payment").alias("voucher_canceled_value"))


def voucher_canceled_share(t: ReportTables) -> DataFrame:
    """One row from two scalar subqueries; NULL if there is no high-value revenue."""
    lost = _voucher_canceled(t).agg(F.coalesce(total("total_payment"), F.lit(0))).scalar()
    hv = t.segment_orders.where(high_value()).agg(total("total_payment")).scalar()
    one_row = t.fact.sparkSession.range(1)
    return one_row.select(percent(lost, hv).alias("pct_of_hv_revenue"))


def _cancel_rate(df: DataFrame, *keys, names=("canceled_orders", "total_orders")) -> DataFrame:
    n_canceled = F.count_if(canceled())
    return df.groupBy(*keys).agg(
        n_canceled.alias(names[0]),
        n_rows().alias(names[1]),
        percent(n_canceled, n_rows()).alias("cancel_rate_pct"),
    )


def cancel_rate_by_type(t: ReportTables) -> DataFrame:
    return _cancel_rate(t.fact, "payment_type").orderBy(F.desc("cancel_rate_pct"), "payment_type")


def revenue_lost_by_type(t: ReportTables) -> DataFrame:
    lost, orders = F.col("lost"), F.col("orders")
    return (
        t.leakage.where(canceled())
        .groupBy("payment_type")
        .agg(
            F.count_distinct("order_id").alias("cancelled_orders"),
            total("total_payment").alias("lost"),
            n_rows().alias("orders"),
        )
        .select(
            "payment_type",
            "cancelled_orders",
            amount(lost).alias("revenue_lost"),
            round2(mean(amount(lost), orders)).alias("avg_lost_per_order"),
            percent(lost, F.sum(lost).over(Window.partitionBy())).alias("pct_of_total_lost"),
        )
        .orderBy(F.desc("revenue_lost"), "payment_type")
    )


def cancel_rate_by_type_and_value(t: ReportTables) -> DataFrame:
    value_range = binned(F.col("total_payment"), C.VALUE_RANGES).alias("value_range")
    return _cancel_rate(t.fact, "payment_type", value_range, names=("canceled", "total")).orderBy(
        F.desc("cancel_rate_pct"), "payment_type", "value_range"
    )


def cancel_rate_by_state(t: ReportTables, top: int = 15) -> DataFrame:
    return (
        _cancel_rate(t.fact, "customer_state")
        .orderBy(F.desc("cancel_rate_pct"), "customer_state")
        .limit(top)
    )


def missed_upsell_categories(t: ReportTables, top: int = 10) -> DataFrame:
    """Expensive items of delivered orders paid by card in one installment."""
    single = t.delivered.where(paid_by(C.CREDIT_CARD) & single_installment()).select("order_id")
    return (
        t.items.where(F.col("price") >= float(C.MISSED_UPSELL_MIN_PRICE))
        .join(single, "order_id")
        .groupBy("category")
        .agg(n_rows().alias("total_orders"), mean_value("price").alias("avg_price"))
        .orderBy(F.desc("total_orders"), "category")
        .limit(top)
    )


def near_threshold_single_card(t: ReportTables) -> DataFrame:
    return t.segment_orders.where(
        near_threshold() & paid_by(C.CREDIT_CARD) & single_installment()
    ).agg(
        F.count_distinct("customer_id").alias("near_threshold_cc_1x_customers"),
        n_rows().alias("total_orders"),
        mean_value("total_payment").alias("avg_order_value"),
    )


def upgrade_scenarios(t: ReportTables) -> DataFrame:
    """The near-threshold rows are counted once and the count is spread over the scenarios."""
    scenarios = F.array(
        *[
            F.struct(F.lit(f"Convert {p}%").alias("scenario"), F.lit(p).alias("percent"))
            for p in C.SCENARIO_PERCENTS
        ]
    )
    projected = F.col("n") * F.col("percent") * C.SCENARIO_VALUE / 100
    return (
        t.segments.where(near_threshold())
        .agg(n_rows().alias("n"))
        .select("n", F.inline(scenarios))
        .select("scenario", F.round(projected, 2).alias("projected_revenue"))
    )


REPORTS = {
    "q15": revenue_at_risk,
    "q7": voucher_at_risk,
    "q7a": voucher_canceled_value,
    "q7b": voucher_canceled_share,
    "q8": cancel_rate_by_type,
    "q8_5": revenue_lost_by_type,
    "a1": cancel_rate_by_type_and_value,
    "a4": cancel_rate_by_state,
    "c1": missed_upsell_categories,
    "c3": near_threshold_single_card,
    "q21": upgrade_scenarios,
}
