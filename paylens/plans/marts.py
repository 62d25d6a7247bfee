"""The eight marts as frames over the sources."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens import constants as C
from paylens.functions.figures import mean, mean_amount, percent, total_value
from paylens.functions.labels import canceled, delivered, segment
from paylens.schemas import TABLES


def _orders() -> Column:
    return F.count("order_id").alias("total_orders")


def _revenue() -> Column:
    return total_value("total_payment").alias("total_revenue")


def _order_value() -> Column:
    return mean_amount("total_payment").alias("avg_order_value")


def fact_payments(orders: DataFrame, payments: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order with a valid payment, whatever its status.

    ``payments`` are the valid ones. The payment type is that of payment number 1; an
    order whose first payment was invalid keeps a NULL type. The three joins on order_id
    share one partitioning per input, and the payments are summed before they are
    shuffled. Customers come last, so the result is laid out by customer.
    """
    paid = payments.groupBy("order_id").agg(
        total_value("payment_value").alias("total_payment"),
        F.max("payment_installments").alias("max_installments"),
    )
    first_payment = payments.where("payment_sequential = 1").select("order_id", "payment_type")
    order = orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    buyer = customers.select("customer_id", "customer_unique_id", "customer_state")
    return (
        order.join(paid, "order_id")
        .join(first_payment, "order_id", "left")
        .join(buyer, "customer_id")
        .select(*TABLES["fact_payments"].columns)
    )


def customer_segments(
    fact: DataFrame, high: float = C.HIGH_MIN, premium: float = C.PREMIUM_MIN
) -> DataFrame:
    """Delivered spending and segment per customer id, person and state.

    A customer id belongs to one order, so this is close to one row per delivered order;
    the person is customer_unique_id.
    """
    return (
        fact.where(delivered())
        .groupBy("customer_id", "customer_unique_id", "customer_state")
        .agg(
            total_value("total_payment").alias("total_spent"),
            F.count("order_id").alias("order_count"),
        )
        .withColumn("segment", segment(F.col("total_spent"), high, premium))
    )


def revenue_by_state(fact: DataFrame) -> DataFrame:
    return fact.where(delivered()).groupBy("customer_state").agg(
        _revenue(),
        _orders(),
        F.count_distinct("customer_id").alias("unique_customers"),
        _order_value(),
    )


def installment_analysis(fact: DataFrame) -> DataFrame:
    return fact.where(delivered()).groupBy("max_installments").agg(
        _order_value(), _orders(), _revenue()
    )


def payment_method_analysis(fact: DataFrame) -> DataFrame:
    """Orders without a first payment type form a group of their own."""
    return fact.where(delivered()).groupBy("payment_type").agg(
        _orders(),
        _revenue(),
        _order_value(),
        mean(F.sum("max_installments"), F.count("max_installments")).alias("avg_installments"),
    )


def revenue_leakage(fact: DataFrame) -> DataFrame:
    status = F.col("order_status")
    label = F.coalesce(*[F.when(status == s, text) for s, text in C.LEAKAGE_LABELS.items()])
    return (
        fact.where(status.isin(*C.LEAKAGE_LABELS))
        .withColumn("leakage_type", label)
        .select(*TABLES["revenue_leakage"].columns)
    )


def order_items_products(
    items: DataFrame, products: DataFrame | None, categories: DataFrame | None = None
) -> DataFrame | None:
    """Every order item with its category, translated where a translation exists.

    Products and translations are joined to each other first, so the items are joined
    (and at most shuffled) once. None without products.
    """
    if products is None:
        return None
    native, english = "product_category_name", "product_category_name_english"
    if categories is None:
        named = products.select("product_id", F.col(native).alias("category"))
    else:
        named = products.join(categories.select(native, english), native, "left").select(
            "product_id", F.coalesce(english, native).alias("category")
        )
    return items.join(named, "product_id", "left").select(*TABLES["order_items_products"].columns)


def seller_orders(
    items: DataFrame, orders: DataFrame, sellers: DataFrame | None
) -> DataFrame | None:
    """Items sold and items of canceled orders per seller (items, not distinct orders).

    Counted per seller before the seller's state is joined, so a seller with a large
    share of all items is one row by then. None without sellers.
    """
    if sellers is None:
        return None
    sold = (
        items.select("order_id", "seller_id")
        .join(orders.select("order_id", "order_status"), "order_id")
        .groupBy("seller_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(canceled()).alias("n_canceled"))
    )
    return (
        sold.join(sellers.select("seller_id", "seller_state"), "seller_id")
        .groupBy("seller_id", "seller_state")
        .agg(F.sum("n").alias("total_orders"), F.sum("n_canceled").alias("canceled_orders"))
        .withColumn("cancel_rate_pct", percent(F.col("canceled_orders"), F.col("total_orders")))
    )


# The sources each mart is made from; the others are made from the order fact.
SOURCES_OF = {
    "fact_payments": ("orders", "payments", "customers"),
    "order_items_products": ("items", "products", "categories"),
    "seller_orders": ("items", "orders", "sellers"),
}

# How to build each mart from the sources and the stored fact mart, in order. A mart
# whose optional source is missing is None.
Frames = Mapping[str, DataFrame | None]
MARTS: dict[str, Callable[[Frames, Callable[[], DataFrame]], DataFrame | None]] = {
    "fact_payments": lambda s, fact: fact_payments(s["orders"], s["payments"], s["customers"]),
    "customer_segments": lambda s, fact: customer_segments(fact()),
    "revenue_by_state": lambda s, fact: revenue_by_state(fact()),
    "installment_analysis": lambda s, fact: installment_analysis(fact()),
    "payment_method_analysis": lambda s, fact: payment_method_analysis(fact()),
    "revenue_leakage": lambda s, fact: revenue_leakage(fact()),
    "order_items_products": lambda s, fact: order_items_products(
        s["items"], s.get("products"), s.get("categories")
    ),
    "seller_orders": lambda s, fact: seller_orders(s["items"], s["orders"], s.get("sellers")),
}
