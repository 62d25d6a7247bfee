"""Geographic distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens import constants as C
from paylens.functions.figures import (
    amount,
    exact,
    mean,
    n_rows,
    percent,
    round2,
    total_value,
    wide_sum,
)
from paylens.functions.labels import high_value, paid_by
from paylens.plans.tables import ReportTables


def top_states_hv_revenue(t: ReportTables, top: int = 8) -> DataFrame:
    return (
        t.segment_orders.where(high_value())
        .groupBy("customer_state")
        .agg(total_value("total_payment").alias("hv_revenue"))
        .orderBy(F.desc("hv_revenue"), "customer_state")
        .limit(top)
    )


def hv_concentration(t: ReportTables, top: int = 15) -> DataFrame:
    hv = F.count_if(high_value())
    return (
        t.segments.groupBy("customer_state")
        .agg(
            hv.alias("hv_count"),
            n_rows().alias("total_count"),
            percent(hv, n_rows()).alias("hv_pct"),
        )
        .orderBy(F.desc("hv_pct"), "customer_state")
        .limit(top)
    )


def state_opportunity(t: ReportTables) -> DataFrame:
    hv_revenue = F.sum(F.when(high_value(), exact("total_spent")))
    return (
        t.segments.groupBy("customer_state")
        .agg(
            amount(F.coalesce(hv_revenue, F.lit(0))).alias("hv_revenue"),
            percent(F.count_if(high_value()), n_rows()).alias("hv_concentration_pct"),
            n_rows().alias("total_customers"),
        )
        .where(F.col("total_customers") >= C.MIN_STATE_CUSTOMERS)
        .orderBy(F.desc("hv_revenue"), "customer_state")
    )


def regional_opportunity(
    t: ReportTables,
    high_revenue: float = C.TIER_HIGH_REVENUE,
    medium_revenue: float = C.TIER_MEDIUM_REVENUE,
    max_installments: float = C.TIER_MAX_INSTALLMENTS,
) -> DataFrame:
    """States with revenue, but few installments among Premium and High persons.

    An order counts once per Premium or High row of its person. The revenue is that of
    all delivered orders of the state; its share is taken over the states present. The
    state table is joined to the result of the aggregation, not to the orders.
    """
    valued = t.person_segments.where(F.col("segment").isin(C.PREMIUM, C.HIGH))
    weighted = F.col("max_installments").cast("decimal(10,0)") * F.col("weight")
    usage = (
        t.delivered.where(paid_by(C.CREDIT_CARD))
        .join(valued, "customer_unique_id")
        .groupBy("customer_state")
        .agg(mean(wide_sum(weighted), wide_sum(F.col("weight"))).alias("usage"))
    )
    revenue = F.col("total_revenue")
    few = F.col("usage") < max_installments
    whole = F.sum(exact("total_revenue")).over(Window.partitionBy())
    return (
        t.states.join(usage, "customer_state")
        .select(
            "customer_state",
            revenue.alias("hv_revenue"),
            F.col("unique_customers").alias("hv_customers"),
            percent(exact("total_revenue"), whole).alias("hv_revenue_pct"),
            round2(F.col("usage")).alias("avg_installments"),
            F.when(few & (revenue > high_revenue), C.TIER_HIGH)
            .when(few & (revenue > medium_revenue), C.TIER_MEDIUM)
            .otherwise(C.TIER_LOW)
            .alias("opportunity_tier"),
        )
        .orderBy(F.desc("hv_revenue"), "customer_state")
    )


REPORTS = {
    "q5": top_states_hv_revenue,
    "q6": hv_concentration,
    "q17": state_opportunity,
    "q17_5": regional_opportunity,
}
