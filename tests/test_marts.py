"""Marts on hand-made rows."""

from __future__ import annotations

import pytest

from paylens.operators.ingest import valid_payments
from paylens.plans import marts
from paylens.schemas import SOURCES


def frame(spark, name, *rows):
    return spark.createDataFrame(
        list(rows), ", ".join(f"{c} {t}" for c, t in SOURCES[name].columns.items())
    )


def fact_of(spark, payments, orders=None, customers=None):
    ids = sorted({p[0] for p in payments})
    orders = orders or [(i, f"c{i}", "delivered", "2017-10-02 10:56:33") for i in ids]
    customers = customers or [(o[1], f"u{o[0]}", "SP") for o in orders]
    paid = [(i, n, kind, parts, float(value)) for i, n, kind, parts, value in payments]
    return marts.fact_payments(
        frame(spark, "orders", *orders),
        valid_payments(frame(spark, "payments", *paid)),
        frame(spark, "customers", *customers),
    )


def test_fact_sums_payments_and_takes_the_first_type(spark):
    fact = fact_of(spark, [("1", 2, "voucher", 1, 5.5), ("1", 1, "credit_card", 3, 10.25)])
    row = fact.collect()
    assert len(row) == 1
    assert (row[0].total_payment, row[0].max_installments) == (15.75, 3)
    assert row[0].payment_type == "credit_card"
    assert (row[0].customer_unique_id, row[0].customer_state) == ("u1", "SP")


def test_fact_without_valid_first_payment_has_null_type(spark):
    row = fact_of(spark, [("1", 1, "not_defined", 1, 9), ("1", 2, "voucher", 1, 50)]).first()
    assert (row.total_payment, row.payment_type) == (50.0, None)


def test_order_with_only_invalid_payments_is_absent(spark):
    fact = fact_of(spark, [("1", 1, "not_defined", 1, 9), ("2", 1, "voucher", 1, 1)])
    assert [r.order_id for r in fact.collect()] == ["2"]


def test_two_first_payments_double_the_order(spark):
    fact = fact_of(spark, [("1", 1, "voucher", 1, 1), ("1", 1, "boleto", 1, 2)])
    assert sorted((r.payment_type, r.total_payment) for r in fact.collect()) == [
        ("boleto", 3.0),
        ("voucher", 3.0),
    ]


def test_order_without_customer_is_absent(spark):
    assert fact_of(spark, [("1", 1, "voucher", 1, 1)], customers=[("x", "u", "SP")]).count() == 0


@pytest.mark.parametrize(
    "spent, label",
    [(0, "Regular"), (199.99, "Regular"), (200, "High"), (399.99, "High"), (400, "Premium")],
)
def test_segment_thresholds(spark, spent, label):
    fact = fact_of(spark, [("1", 1, "voucher", 1, spent)])
    assert marts.customer_segments(fact).first().segment == label


def test_amounts_below_a_cent_decide_the_segment(spark):
    paid = [("1", 1, "voucher", 1, 399.995), ("1", 2, "voucher", 1, 0.004)]
    row = marts.customer_segments(fact_of(spark, paid)).first()
    assert (row.total_spent, row.segment) == (399.999, "High")


def test_segments_are_delivered_only_and_per_customer_id(spark):
    orders = [
        ("1", "c1", "delivered", ""),
        ("2", "c2", "delivered", ""),
        ("3", "c2", "delivered", ""),
        ("4", "c3", "canceled", ""),
    ]
    customers = [("c1", "u", "SP"), ("c2", "u", "SP"), ("c3", "u", "SP")]
    paid = [(str(i), 1, "voucher", 1, 100) for i in range(1, 5)]
    result = marts.customer_segments(fact_of(spark, paid, orders, customers))
    assert sorted((r.customer_id, r.total_spent, r.order_count) for r in result.collect()) == [
        ("c1", 100.0, 1),
        ("c2", 200.0, 2),
    ]


def test_payment_methods_keep_the_null_group(spark):
    paid = [("1", 1, None, 2, 10), ("2", 1, "voucher", 1, 1), ("3", 1, "voucher", 4, 2)]
    rows = marts.payment_method_analysis(fact_of(spark, paid)).collect()
    result = {r.payment_type: r for r in rows}
    assert set(result) == {None, "voucher"}
    assert result["voucher"].total_orders == 2
    assert result["voucher"].avg_order_value == 1.5
    assert result["voucher"].avg_installments == 2.5
    assert result[None].avg_installments == 2.0


def test_installments_and_states(spark):
    paid = [("1", 1, "boleto", 2, 10), ("2", 1, "voucher", 2, 20), ("3", 1, "voucher", 1, 1)]
    fact = fact_of(spark, paid)
    result = {r.max_installments: r for r in marts.installment_analysis(fact).collect()}
    assert (result[2].avg_order_value, result[2].total_orders) == (15.0, 2)
    state = marts.revenue_by_state(fact).first()
    assert (state.total_revenue, state.total_orders, state.unique_customers) == (31, 3, 3)


def test_leakage_labels(spark):
    statuses = ["canceled", "unavailable", "shipped", "delivered"]
    orders = [(str(i), f"c{i}", s, "") for i, s in enumerate(statuses)]
    paid = [(str(i), 1, "voucher", 1, 1) for i in range(4)]
    result = marts.revenue_leakage(fact_of(spark, paid, orders)).collect()
    assert sorted((r.order_status, r.leakage_type) for r in result) == [
        ("canceled", "Canceled Order"),
        ("unavailable", "Unavailable Order"),
    ]


def items(spark, *rows):
    return frame(spark, "items", *[(*r, 1.0, 0.5) for r in rows])


def test_item_categories(spark):
    bought = items(spark, ("1", "p1", "s"), ("1", "p2", "s"), ("2", "p3", "s"), ("2", None, "s"))
    products = frame(spark, "products", ("p1", "beleza"), ("p2", "sem_nome"))
    categories = frame(spark, "categories", ("beleza", "beauty"))

    def category(df):
        return {r.product_id: r.category for r in df.collect()}

    translated = marts.order_items_products(bought, products, categories)
    assert category(translated) == {"p1": "beauty", "p2": "sem_nome", "p3": None, None: None}
    assert translated.count() == 4
    native = marts.order_items_products(bought, products)
    assert category(native) == {"p1": "beleza", "p2": "sem_nome", "p3": None, None: None}
    assert marts.order_items_products(bought, None, categories) is None


def test_duplicate_translations_multiply_items(spark):
    bought = items(spark, ("1", "p1", "s"))
    products = frame(spark, "products", ("p1", "beleza"))
    categories = frame(spark, "categories", ("beleza", "beauty"), ("beleza", "care"))
    result = marts.order_items_products(bought, products, categories).collect()
    assert sorted(r.category for r in result) == ["beauty", "care"]


def test_seller_orders_count_items(spark):
    bought = items(spark, ("1", "p", "s1"), ("1", "p", "s1"), ("2", "p", "s1"), ("3", "p", "s2"))
    orders = frame(
        spark,
        "orders",
        ("1", "c", "delivered", ""),
        ("2", "c", "canceled", ""),
        ("3", "c", None, ""),
    )
    sellers = frame(spark, "sellers", ("s1", "SP"), ("s2", "RJ"), ("s3", "MG"))
    result = {r.seller_id: r for r in marts.seller_orders(bought, orders, sellers).collect()}
    assert set(result) == {"s1", "s2"}
    s1 = result["s1"]
    assert (s1.total_orders, s1.canceled_orders, s1.cancel_rate_pct) == (3, 1, 33.33)
    assert (result["s2"].canceled_orders, result["s2"].cancel_rate_pct) == (0, 0.0)
    assert marts.seller_orders(bought, orders, None) is None


def test_duplicate_seller_rows_multiply_the_counts(spark):
    bought = items(spark, ("1", "p", "s1"))
    orders = frame(spark, "orders", ("1", "c", "canceled", ""))
    sellers = frame(spark, "sellers", ("s1", "SP"), ("s1", "SP"), ("s1", "RJ"))
    result = marts.seller_orders(bought, orders, sellers).collect()
    assert sorted((r.seller_state, r.total_orders) for r in result) == [("RJ", 1), ("SP", 2)]
