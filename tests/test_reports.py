"""Reports on hand-made published rows."""

from __future__ import annotations

import pytest

from paylens.plans.reports import REPORTS, SECTIONS, run_section
from paylens.plans.reports.geography import regional_opportunity
from paylens.plans.tables import ReportTables


def order(i, paid=100.0, kind="credit_card", parts=1, person=None, **more):
    row = {
        "order_id": f"o{i}",
        "customer_id": f"c{i}",
        "order_status": "delivered",
        "order_purchase_timestamp": "2017-10-02 10:56:33",
        "total_payment": float(paid),
        "max_installments": parts,
        "payment_type": kind,
        "customer_unique_id": person or f"u{i}",
        "customer_state": "SP",
    }
    return {**row, **more}


def segment_of(row):
    spent = row["total_payment"]
    return {
        "customer_id": row["customer_id"],
        "customer_unique_id": row["customer_unique_id"],
        "customer_state": row["customer_state"],
        "total_spent": spent,
        "order_count": 1,
        "segment": "Premium" if spent >= 400 else "High" if spent >= 200 else "Regular",
    }


@pytest.fixture
def orders(tables):
    def build(*facts, **more):
        done = [segment_of(f) for f in facts if f["order_status"] == "delivered"]
        lost = [
            {**f, "leakage_type": "x"}
            for f in facts
            if f["order_status"] in ("canceled", "unavailable")
        ]
        return tables(
            **{"fact_payments": facts, "customer_segments": done, "revenue_leakage": lost, **more}
        )

    return build


def test_sections_hold_all_36_reports_once():
    listed = [key for keys in SECTIONS.values() for key in keys]
    assert len(listed) == len(set(listed)) == len(REPORTS) == 36
    assert [len(keys) for keys in SECTIONS.values()] == [8, 5, 8, 4, 11]


def test_run_section(orders):
    result = run_section("Executive Summary", orders(order(1), order(2, 450)))
    assert set(result) == set(SECTIONS["Executive Summary"])
    assert result["q12"].first().total_orders == 2


def test_spending_bins_and_running_share(orders, rows):
    t = orders(order(1, 0), order(2, 99.99), order(3, 100), order(4, 250))
    assert rows(REPORTS["q0a"](t)) == [(0.0, 2), (100.0, 1), (200.0, 1)]
    assert rows(REPORTS["q0b"](t)) == [
        (0.0, 2, 50.0, 50.0),
        (100.0, 1, 25.0, 75.0),
        (200.0, 1, 25.0, 100.0),
    ]


def test_spending_distribution_shows_the_first_twenty_bins(orders, rows):
    t = orders(*[order(i, i * 100) for i in range(25)])
    table = REPORTS["q0b"](t).select("spending_bin", "customer_count")
    assert rows(REPORTS["q0a"](t)) == rows(table)[:20]


def test_histogram_edges_and_order(orders, rows):
    t = orders(*[order(i, v) for i, v in enumerate([500, 49.99, 50, 399.99, 400, 499.99, 10])])
    assert rows(REPORTS["q19"](t)) == [
        ("R$0-50", 2),
        ("R$50-100", 1),
        ("R$300-400", 1),
        ("R$400-500", 2),
        ("R$500+", 1),
    ]


def test_revenue_and_target(orders, rows):
    t = orders(order(1, 0.1), order(2, 0.2), order(3, 9, order_status="canceled"))
    assert rows(REPORTS["q11"](t)) == [(0.3, 0.36)]


def test_blank_and_broken_times(orders, rows):
    t = orders(
        order(1, 300, order_purchase_timestamp=""),
        order(2, 300),
        order(3, 200, order_purchase_timestamp="2018-01-31 23:59:59"),
    )
    assert rows(REPORTS["q10"](t)) == [("2017-10", 300.0), ("2018-01", 200.0)]
    assert rows(REPORTS["q13"](t)) == [("Q1-2018", 200.0), ("Q4-2017", 300.0)]
    assert rows(REPORTS["q14"](t)) == [("Q1-2018", 1), ("Q4-2017", 1)]
    assert rows(REPORTS["q23b"](t)) == [(10, 1, 1), (23, 1, 1)]
    assert rows(REPORTS["q12"](t)) == [(3,)]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, orders, rows, zone):
    sunday, monday = "2024-01-07 00:30:00", "2024-01-08 23:30:00"
    gap = "2018-11-04 00:30:00"  # skipped in Sao Paulo by the change to summer time
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        t = orders(
            order(1, 50, order_purchase_timestamp=sunday),
            order(2, 250, order_purchase_timestamp=monday),
            order(3, 250, order_purchase_timestamp=gap),
        )
        assert rows(REPORTS["q23a"](t)) == [(1, 1, 1), (7, 2, 1)]
        assert rows(REPORTS["q23b"](t)) == [(0, 2, 1), (23, 1, 1)]
        assert rows(REPORTS["q10"](t)) == [("2018-11", 250.0), ("2024-01", 250.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_repeat_rate_counts_segment_rows_by_orders_of_the_person(orders, rows):
    t = orders(
        order(1, 500, person="p"), order(2, 500, person="p"), order(3, 500), order(4, 10)
    )
    assert rows(REPORTS["q18"](t)) == [("Premium", 2, 3, 66.67), ("Regular", 0, 1, 0.0)]


def test_hv_flag_does_not_multiply(tables, rows):
    first, second = order(1, 300), {**segment_of(order(1, 300)), "customer_state": "RJ"}
    t = tables(fact_payments=[first], customer_segments=[segment_of(first), second])
    assert rows(REPORTS["q23b"](t)) == [(10, 1, 1)]


def test_methods_by_segment(orders, rows):
    t = orders(
        order(1, 10), order(2, 10, "boleto"), order(3, 10, ""), order(4, 500, "voucher"),
        order(5, 500, "debit_card"),
    )
    assert rows(REPORTS["q3"](t)) == [("Premium", 0, 0, 1, 1), ("Regular", 1, 1, 0, 0)]


def test_premium_mix_counts_an_order_once_per_premium_row_of_its_person(orders, rows):
    t = orders(
        order(1, 400, person="p"),
        order(2, 500, "voucher", person="p"),
        order(3, 10, "voucher", person="p"),
        order(4, 90, "boleto"),
    )
    assert rows(REPORTS["q3_5"](t)) == [
        ("Premium", "voucher", 2, 1020.0, 56.04),
        ("Premium", "credit_card", 1, 800.0, 43.96),
    ]


def test_installment_groups(orders, rows):
    t = orders(order(1, 10, parts=0), order(2, 20, parts=1), order(3, 40, parts=2))
    assert rows(REPORTS["q9"](t)) == [
        ("2x+ (Installment)", 25.0, 2),
        ("1x (Single Payment)", 20.0, 1),
    ]


def test_installment_range(orders, rows):
    card = [order(i, 10, parts=n) for i, n in enumerate([0, 1, 10, 11])]
    t = orders(*card, order(9, 5, "boleto"))
    assert rows(REPORTS["q16"](t)) == [(1, 10.0, 1), (10, 10.0, 1)]


def test_average_is_rounded_as_written(orders, rows):
    t = orders(order(1, 1.00), order(2, 1.01))
    assert rows(REPORTS["q16"](t)) == [(1, 1.01, 2)]  # 1.005, which a double cannot hold


def test_voucher_users(orders, rows):
    t = orders(
        order(1, 10, "voucher", person="p"), order(2, 10, person="p"),
        order(3, 10, person="q"), order(4, 10, ""),
    )
    assert rows(REPORTS["b1"](t)) == [("Voucher User", 1, 1, 100.0), ("Non-Voucher", 0, 2, 0.0)]
    assert rows(REPORTS["b2"](t)) == [("With Voucher", 10.0, 1), ("Without Voucher", 10.0, 3)]
    assert rows(REPORTS["b3"](t)) == [("Regular", 1, 4, 25.0)]


def test_top_states_break_ties_by_name(orders, rows):
    t = orders(*[order(i, 300, customer_state=f"S{i:02d}") for i in range(20)])
    assert rows(REPORTS["q5"](t)) == [(f"S{i:02d}", 300.0) for i in range(8)]
    assert [r[0] for r in rows(REPORTS["q6"](t))] == [f"S{i:02d}" for i in range(15)]
    assert [r[0] for r in rows(REPORTS["a4"](t))] == [f"S{i:02d}" for i in range(15)]


def test_state_opportunity_needs_fifty_rows(orders, rows):
    t = orders(
        *[order(i, 200 if i else 100) for i in range(50)],
        *[order(100 + i, 300, customer_state="RJ") for i in range(49)],
    )
    assert rows(REPORTS["q17"](t)) == [("SP", 9800.0, 98.0, 50)]


def test_regional_opportunity(orders, rows):
    state = {"total_orders": 9, "unique_customers": 7, "avg_order_value": 1.0}
    t = orders(
        order(1, 500, parts=1, person="p"),
        order(2, 300, parts=4, person="p"),
        order(3, 10, parts=10, person="p"),
        order(4, 10, parts=10),
        order(5, 300, parts=10, kind="boleto", person="p"),
        revenue_by_state=[
            {**state, "customer_state": "SP", "total_revenue": 600000.0},
            {**state, "customer_state": "RJ", "total_revenue": 1.0},
        ],
    )
    # p has three valued rows; the card orders 1, 2 and 3 count three times each
    assert rows(REPORTS["q17_5"](t)) == [("SP", 600000.0, 7, 100.0, 5.0, "Low Priority")]
    assert rows(regional_opportunity(t, max_installments=5.01))[0][-1] == "High Priority"
    assert rows(regional_opportunity(t, 600000, 1, 5.01))[0][-1] == "Medium Priority"
    assert rows(regional_opportunity(t, 600000, 600000, 5.01))[0][-1] == "Low Priority"


def test_nothing_lost(orders, rows):
    t = orders(order(1, 300))
    assert rows(REPORTS["q15"](t)) == [(0.0,)]
    assert rows(REPORTS["q7a"](t)) == [(0.0,)]
    assert sorted(rows(REPORTS["q7"](t))) == [("Total Revenue", 300.0), ("Voucher at Risk", 0.0)]
    assert rows(REPORTS["q7b"](t)) == [(0.0,)]
    assert rows(REPORTS["q8_5"](t)) == []


def test_voucher_share_without_hv_revenue_is_null(orders, rows):
    t = orders(order(1, 10), order(2, 5, "voucher", order_status="canceled"))
    assert rows(REPORTS["q7b"](t)) == [(None,)]


def test_losses(orders, rows):
    t = orders(
        order(1, 300),
        order(2, 30, "voucher", order_status="canceled"),
        order(3, 60, "boleto", order_status="canceled"),
        order(4, 90, "boleto", order_status="unavailable"),
    )
    assert rows(REPORTS["q15"](t)) == [(180.0,)]
    assert rows(REPORTS["q7b"](t)) == [(10.0,)]
    assert rows(REPORTS["q8_5"](t)) == [
        ("boleto", 1, 60.0, 60.0, 66.67),
        ("voucher", 1, 30.0, 30.0, 33.33),
    ]
    assert rows(REPORTS["q8"](t)) == [
        ("voucher", 1, 1, 100.0),
        ("boleto", 1, 2, 50.0),
        ("credit_card", 0, 1, 0.0),
    ]


def test_value_ranges(orders, rows):
    t = orders(*[order(i, v) for i, v in enumerate([99.99, 100, 299.99, 300])])
    assert [r[1:4] for r in rows(REPORTS["a1"](t))] == [
        ("High (>R$300)", 0, 1),
        ("Low (<R$100)", 0, 1),
        ("Mid (R$100-300)", 0, 2),
    ]


def test_missed_upsell(orders, rows):
    def item(i, price, category):
        return {"order_id": f"o{i}", "price": price, "category": category}

    t = orders(
        order(1), order(2, parts=2), order(3, kind="boleto"),
        order_items_products=[
            item(1, 150.0, "a"), item(1, 151.01, "a"), item(1, 149.99, "a"), item(1, 200.0, None),
            item(2, 500.0, "b"), item(3, 500.0, "c"),
        ],
    )
    assert rows(REPORTS["c1"](t)) == [("a", 2, 150.51), ("", 1, 200.0)]


def test_near_threshold(orders, rows):
    single = [order(i, v) for i, v in enumerate([149.99, 150, 200, 200.01])]
    t = orders(*single, order(9, 160, parts=2))
    assert rows(REPORTS["c3"](t)) == [(2, 2, 175.0)]
    assert rows(REPORTS["q21"](t)) == [
        ("Convert 10%", 60.0),
        ("Convert 25%", 150.0),
        ("Convert 50%", 300.0),
        ("Convert 100%", 600.0),
    ]


def test_reports_over_empty_tables(tables):
    t = tables()
    for key, report in REPORTS.items():
        report(t).collect()


def test_weighted_sums_leave_the_bigint_range(spark, tables, rows):
    """A person with very many orders and segment rows."""
    t = tables(
        fact_payments=[order(1, 10**9, person="p", parts=9), order(2, 10**9, person="p", parts=8)],
        revenue_by_state=[{"customer_state": "SP", "total_revenue": 1.0}],
    )
    weights = spark.createDataFrame([("p", "Premium", 3 * 10**18)], t.person_segments.schema)
    t = ReportTables(t._read, lambda name, df: weights if name == "person_segments" else df)
    assert rows(REPORTS["q3_5"](t)) == [("Premium", "credit_card", 2, 6e27, 100.0)]
    assert rows(REPORTS["q17_5"](t))[0][4] == 8.5
