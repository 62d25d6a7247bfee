"""The seven sources and the eight published tables."""

from __future__ import annotations

from dataclasses import dataclass

# Decimals that amounts may have; sums are exact to this place.
MONEY_SCALE = 6


@dataclass(frozen=True)
class SourceSpec:
    """A raw CSV file: the columns the marts need (others are landed as text).

    ``money`` names the columns that hold amounts, of at most ``MONEY_SCALE`` decimals.
    """

    name: str
    file: str
    columns: dict[str, str]
    required: bool = True
    money: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    """A published table: ordered columns with their types, and the column rows are sorted on."""

    name: str
    columns: dict[str, str]
    cluster_by: str

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())


SOURCES = {
    s.name: s
    for s in (
        SourceSpec(
            "orders",
            "orders.csv",
            {
                "order_id": "string",
                "customer_id": "string",
                "order_status": "string",
                "order_purchase_timestamp": "string",
            },
        ),
        SourceSpec(
            "payments",
            "order_payments.csv",
            {
                "order_id": "string",
                "payment_sequential": "int",
                "payment_type": "string",
                "payment_installments": "int",
                "payment_value": "double",
            },
            money=("payment_value",),
        ),
        SourceSpec(
            "customers",
            "customers.csv",
            {"customer_id": "string", "customer_unique_id": "string", "customer_state": "string"},
        ),
        SourceSpec(
            "items",
            "order_items.csv",
            {
                "order_id": "string",
                "product_id": "string",
                "seller_id": "string",
                "price": "double",
                "freight_value": "double",
            },
            money=("price", "freight_value"),
        ),
        SourceSpec(
            "sellers",
            "sellers.csv",
            {"seller_id": "string", "seller_state": "string"},
            required=False,
        ),
        SourceSpec(
            "products",
            "products.csv",
            {"product_id": "string", "product_category_name": "string"},
            required=False,
        ),
        SourceSpec(
            "categories",
            "category_translation.csv",
            {"product_category_name": "string", "product_category_name_english": "string"},
            required=False,
        ),
    )
}

TABLES = {
    t.name: t
    for t in (
        TableSpec(
            "fact_payments",
            {
                "order_id": "string",
                "customer_id": "string",
                "order_status": "string",
                "order_purchase_timestamp": "string",
                "total_payment": "double",
                "max_installments": "int",
                "payment_type": "string",
                "customer_unique_id": "string",
                "customer_state": "string",
            },
            "order_id",
        ),
        TableSpec(
            "customer_segments",
            {
                "customer_id": "string",
                "customer_unique_id": "string",
                "customer_state": "string",
                "total_spent": "double",
                "order_count": "int",
                "segment": "string",
            },
            "total_spent",
        ),
        TableSpec(
            "revenue_by_state",
            {
                "customer_state": "string",
                "total_revenue": "double",
                "total_orders": "bigint",
                "unique_customers": "bigint",
                "avg_order_value": "double",
            },
            "total_revenue",
        ),
        TableSpec(
            "installment_analysis",
            {
                "max_installments": "int",
                "avg_order_value": "double",
                "total_orders": "bigint",
                "total_revenue": "double",
            },
            "max_installments",
        ),
        TableSpec(
            "payment_method_analysis",
            {
                "payment_type": "string",
                "total_orders": "bigint",
                "total_revenue": "double",
                "avg_order_value": "double",
                "avg_installments": "double",
            },
            "total_revenue",
        ),
        TableSpec(
            "revenue_leakage",
            {
                "order_id": "string",
                "order_status": "string",
                "payment_type": "string",
                "customer_state": "string",
                "total_payment": "double",
                "leakage_type": "string",
                "order_purchase_timestamp": "string",
            },
            "order_id",
        ),
        TableSpec(
            "order_items_products",
            {
                "order_id": "string",
                "product_id": "string",
                "seller_id": "string",
                "price": "double",
                "freight_value": "double",
                "category": "string",
            },
            "order_id",
        ),
        TableSpec(
            "seller_orders",
            {
                "seller_id": "string",
                "seller_state": "string",
                "total_orders": "bigint",
                "canceled_orders": "bigint",
                "cancel_rate_pct": "double",
            },
            "cancel_rate_pct",
        ),
    )
}
