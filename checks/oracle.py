"""Independent SQL for every registered query, run by DuckDB on the supplied tables.

Each statement starts from the same common table expressions: the seven sources, the
eight marts, and the published form of the marts (``p_`` prefix). Joins that the package
replaces by weights or semi joins are written out here.
"""

from __future__ import annotations


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(24,6))"


def total(x: str) -> str:
    return f"COALESCE(CAST(SUM({money(x)}) AS DOUBLE), 0)"


def round2(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), 2) AS DOUBLE)"


def average(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / COUNT({x}))"


def percent(part: str, whole: str) -> str:
    return round2(f"CAST({part} AS DOUBLE) * 100 / NULLIF(CAST({whole} AS DOUBLE), 0)")


def binned(x: str, bins: list[tuple[int, str]], last: str) -> str:
    arms = " ".join(f"WHEN {x} < {edge} THEN '{label}'" for edge, label in bins)
    return f"CASE {arms} ELSE '{last}' END"


SOURCES = """
all_payments AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      l_extendedprice, l_shipdate, l_quantity) AS INTEGER) AS payment_sequential,
    CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN 'not_defined'
      WHEN l_linenumber = 7 AND l_returnflag = 'R' AND l_quantity < 5 THEN NULL
      WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'boleto'
      WHEN l_returnflag = 'N' AND l_linenumber <= 3 THEN 'voucher'
      WHEN l_returnflag = 'N' THEN 'debit_card' ELSE 'credit_card' END AS payment_type,
    CASE WHEN l_returnflag = 'N' THEN 1
      ELSE 1 + CAST(l_quantity AS INTEGER) % 10 END AS payment_installments,
    FLOOR(l_extendedprice / 10) / 100 AS payment_value
  FROM lineitem),
payments AS (SELECT * FROM all_payments WHERE payment_type IS DISTINCT FROM 'not_defined'),
src_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(o_orderkey + 1000000 AS VARCHAR) AS customer_id,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'canceled'
      WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'unavailable'
      WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'shipped'
      ELSE 'delivered' END AS order_status,
    CASE WHEN o_orderkey % 97 = 0 THEN ''
      ELSE STRFTIME(o_orderdate + TO_HOURS(o_orderkey % 24) + TO_MINUTES(o_orderkey % 60),
        '%Y-%m-%d %H:%M:%S') END AS order_purchase_timestamp
  FROM orders),
customers AS (
  SELECT CAST(o_orderkey + 1000000 AS VARCHAR) AS customer_id,
    CAST(c_custkey AS VARCHAR) AS customer_unique_id, n_name AS customer_state
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    FLOOR(l_extendedprice / 2) / 100 AS price, l_quantity / 2 AS freight_value
  FROM lineitem),
sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN p_size <> 1 THEN LOWER(p_type) END AS product_category_name
  FROM part),
categories AS (
  SELECT DISTINCT LOWER(p_type) AS product_category_name,
    'en_' || LOWER(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'ECONOMY')"""

MARTS = f"""
fact_payments AS MATERIALIZED (
  SELECT order_id, customer_id, order_status, order_purchase_timestamp,
    CAST(paid AS DOUBLE) AS total_payment, CAST(parts AS INTEGER) AS max_installments,
    payment_type, customer_unique_id, customer_state
  FROM (SELECT order_id, SUM({money("payment_value")}) AS paid, MAX(payment_installments) AS parts
        FROM payments GROUP BY ALL)
  JOIN src_orders USING (order_id)
  JOIN customers USING (customer_id)
  LEFT JOIN (SELECT order_id, payment_type FROM payments WHERE payment_sequential = 1)
    USING (order_id)),
done AS (
  SELECT *, {money("total_payment")} AS paid FROM fact_payments WHERE order_status = 'delivered'),
customer_segments AS MATERIALIZED (
  SELECT customer_id, customer_unique_id, customer_state, CAST(spent AS DOUBLE) AS total_spent,
    CAST(n AS INTEGER) AS order_count,
    CASE WHEN spent < 200 THEN 'Regular' WHEN spent < 400 THEN 'High' ELSE 'Premium' END AS segment
  FROM (SELECT customer_id, customer_unique_id, customer_state, SUM(paid) AS spent, COUNT(*) AS n
        FROM done GROUP BY ALL)),
revenue_by_state AS (
  SELECT customer_state, CAST(SUM(paid) AS DOUBLE) AS total_revenue, COUNT(*) AS total_orders,
    COUNT(DISTINCT customer_id) AS unique_customers, {average("paid")} AS avg_order_value
  FROM done GROUP BY ALL),
installment_analysis AS (
  SELECT max_installments, {average("paid")} AS avg_order_value, COUNT(*) AS total_orders,
    CAST(SUM(paid) AS DOUBLE) AS total_revenue
  FROM done GROUP BY ALL),
payment_method_analysis AS (
  SELECT payment_type, COUNT(*) AS total_orders, CAST(SUM(paid) AS DOUBLE) AS total_revenue,
    {average("paid")} AS avg_order_value, {average("max_installments")} AS avg_installments
  FROM done GROUP BY ALL),
revenue_leakage AS (
  SELECT order_id, order_status, payment_type, customer_state, total_payment,
    IF(order_status = 'canceled', 'Canceled Order', 'Unavailable Order') AS leakage_type,
    order_purchase_timestamp
  FROM fact_payments WHERE order_status = 'canceled' OR order_status = 'unavailable'),
order_items_products AS (
  SELECT order_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
    CAST(freight_value AS DOUBLE) AS freight_value,
    IFNULL(product_category_name_english, product_category_name) AS category
  FROM items LEFT JOIN products USING (product_id)
  LEFT JOIN categories USING (product_category_name)),
seller_orders AS (
  SELECT seller_id, seller_state, COUNT(*) AS total_orders,
    COUNT(*) FILTER (order_status = 'canceled') AS canceled_orders,
    {percent("COUNT(*) FILTER (order_status = 'canceled')", "COUNT(*)")} AS cancel_rate_pct
  FROM sellers JOIN items USING (seller_id) JOIN src_orders USING (order_id) GROUP BY ALL)"""

# Text and number columns that can be missing before publishing.
COLUMNS = {
    "fact_payments": (
        "order_id customer_id order_status order_purchase_timestamp payment_type "
        "customer_unique_id customer_state",
        "total_payment max_installments",
    ),
    "customer_segments": (
        "customer_id customer_unique_id customer_state segment",
        "total_spent order_count",
    ),
    "revenue_by_state": (
        "customer_state",
        "total_revenue total_orders unique_customers avg_order_value",
    ),
    "installment_analysis": ("", "max_installments avg_order_value total_orders total_revenue"),
    "payment_method_analysis": (
        "payment_type",
        "total_orders total_revenue avg_order_value avg_installments",
    ),
    "revenue_leakage": (
        "order_id order_status payment_type customer_state leakage_type order_purchase_timestamp",
        "total_payment",
    ),
    "order_items_products": ("order_id product_id seller_id category", "price freight_value"),
    "seller_orders": ("seller_id seller_state", "total_orders canceled_orders cancel_rate_pct"),
}


def published(name: str) -> str:
    texts, numbers = COLUMNS[name]
    columns = [f"IFNULL({c}, '') AS {c}" for c in texts.split()]
    columns += [f"IFNULL({c}, 0) AS {c}" for c in numbers.split()]
    return f"SELECT {', '.join(columns)} FROM {name}"


PUBLISHED = ",\n".join(f"p_{name} AS ({published(name)})" for name in COLUMNS)

SHORT = f"""
fp AS (SELECT * FROM p_fact_payments),
dl AS (SELECT *, CASE WHEN order_purchase_timestamp <> '' THEN
    STRPTIME(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') END AS bought_at
  FROM fp WHERE order_status = 'delivered'),
cs AS (SELECT * FROM p_customer_segments),
rl AS (SELECT * FROM p_revenue_leakage),
hv AS (SELECT customer_id FROM cs WHERE total_spent >= 200),
so AS (SELECT dl.* EXCLUDE (customer_state), cs.customer_state, cs.total_spent, cs.segment
  FROM dl JOIN cs USING (customer_id)),
po AS (SELECT dl.*, cs.segment FROM dl JOIN cs USING (customer_unique_id))"""

PREFIX = f"WITH {SOURCES.strip()},\n{MARTS.strip()},\n{PUBLISHED},\n{SHORT.strip()}\n"

CANCELED = "COUNT(*) FILTER (order_status = 'canceled')"
HV_ROWS = "COUNT(*) FILTER (total_spent >= 200)"
BY_VOUCHER = "COUNT(*) FILTER (payment_type = 'voucher')"
QUARTER = "'Q' || QUARTER(bought_at) || '-' || YEAR(bought_at)"
VALUE_BINS = binned(
    "total_payment",
    [
        (50, "R$0-50"),
        (100, "R$50-100"),
        (150, "R$100-150"),
        (200, "R$150-200"),
        (250, "R$200-250"),
        (300, "R$250-300"),
        (400, "R$300-400"),
        (500, "R$400-500"),
    ],
    "R$500+",
)
VALUE_RANGES = binned(
    "total_payment", [(100, "Low (<R$100)"), (300, "Mid (R$100-300)")], "High (>R$300)"
)
SPENDING_BINS = """SELECT FLOOR(total_spent / 100) * 100 AS spending_bin,
    COUNT(*) AS customer_count FROM cs GROUP BY ALL"""


def regional(high: int, medium: int, parts: int) -> str:
    return f"""
SELECT customer_state, total_revenue AS hv_revenue, unique_customers AS hv_customers,
  {percent(money("total_revenue"), f"SUM({money('total_revenue')}) OVER ()")} AS hv_revenue_pct,
  {round2("usage")} AS avg_installments,
  CASE WHEN usage >= {parts} THEN 'Low Priority' WHEN total_revenue > {high} THEN 'High Priority'
    WHEN total_revenue > {medium} THEN 'Medium Priority' ELSE 'Low Priority' END AS opportunity_tier
FROM p_revenue_by_state JOIN (
  SELECT customer_state, {average("max_installments")} AS usage FROM po
  WHERE segment IN ('Premium', 'High') AND payment_type = 'credit_card' GROUP BY ALL)
  USING (customer_state)"""


def volume(part: str, name: str) -> str:
    return f"""
SELECT CAST({part} AS INTEGER) AS {name}, COUNT(*) AS all_orders,
  COUNT(*) FILTER (customer_id IN (SELECT customer_id FROM hv)) AS hv_orders
FROM dl WHERE bought_at IS NOT NULL GROUP BY ALL"""


def cancel_rate(keys: str, n_canceled: str = "canceled_orders", n: str = "total_orders") -> str:
    return f"""
SELECT {keys}, {CANCELED} AS {n_canceled}, COUNT(*) AS {n},
  {percent(CANCELED, "COUNT(*)")} AS cancel_rate_pct
FROM fp GROUP BY ALL"""


REPORTS = {
    "q0a": f"{SPENDING_BINS} ORDER BY spending_bin LIMIT 20",
    "q0b": f"""
SELECT *, {percent("customer_count", "SUM(customer_count) OVER ()")} AS pct_customers,
  {percent("SUM(customer_count) OVER (ORDER BY spending_bin)", "SUM(customer_count) OVER ()")}
    AS cumulative_pct
FROM ({SPENDING_BINS})""",
    "q19": f"SELECT {VALUE_BINS} AS value_bin, COUNT(*) AS total_orders FROM dl GROUP BY ALL",
    "q12": "SELECT COUNT(*) AS total_orders FROM dl",
    "q11": f"""
SELECT {total("total_payment")} AS actual_revenue,
  IFNULL(CAST(ROUND(SUM({money("total_payment")}) * CAST(1.2 AS DECIMAL(2,1)), 2) AS DOUBLE), 0)
    AS target_revenue
FROM dl""",
    "q1": "SELECT segment, COUNT(*) AS total_orders FROM cs GROUP BY ALL",
    "q2": f"SELECT segment, {total('total_payment')} AS total_revenue FROM so GROUP BY ALL",
    "q10": f"""
SELECT STRFTIME(bought_at, '%Y-%m') AS month, {total("total_payment")} AS hv_revenue
FROM so WHERE total_spent >= 200 AND bought_at IS NOT NULL GROUP BY ALL""",
    "q13": f"""
SELECT {QUARTER} AS quarter, {total("total_payment")} AS hv_revenue
FROM so WHERE total_spent >= 200 AND bought_at IS NOT NULL GROUP BY ALL""",
    "q14": f"""
SELECT {QUARTER} AS quarter, COUNT(*) AS total_orders
FROM dl WHERE bought_at IS NOT NULL GROUP BY ALL""",
    "q18": f"""
SELECT segment, COUNT(*) FILTER (n > 1) AS repeat_customers, COUNT(*) AS total_customers,
  {percent("COUNT(*) FILTER (n > 1)", "COUNT(*)")} AS repeat_rate_pct
FROM cs JOIN (SELECT customer_unique_id, COUNT(*) AS n FROM dl GROUP BY ALL)
  USING (customer_unique_id)
GROUP BY ALL""",
    "q23a": volume("ISODOW(bought_at)", "day_of_week"),
    "q23b": volume("HOUR(bought_at)", "hour_of_day"),
    "q3": """
SELECT segment, COUNT(*) FILTER (payment_type = 'credit_card') AS credit_card,
  COUNT(*) FILTER (payment_type = 'boleto') AS boleto,
  COUNT(*) FILTER (payment_type = 'debit_card') AS debit_card,
  COUNT(*) FILTER (payment_type = 'voucher') AS voucher
FROM so GROUP BY ALL""",
    "q3_5": f"""
SELECT segment, payment_type, n AS total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
  {percent("revenue", "SUM(revenue) OVER ()")} AS revenue_pct
FROM (SELECT segment, payment_type, COUNT(DISTINCT order_id) AS n,
        SUM({money("total_payment")}) AS revenue
      FROM po WHERE segment = 'Premium' GROUP BY ALL)""",
    "q4": """
SELECT max_installments, COUNT(*) AS total_orders
FROM so WHERE total_spent >= 200 AND payment_type = 'credit_card' GROUP BY ALL""",
    "q9": f"""
SELECT IF(max_installments = 1, '1x (Single Payment)', '2x+ (Installment)') AS installment_group,
  {round2(average(money("total_payment")))} AS avg_order_value, COUNT(*) AS total_orders
FROM dl GROUP BY ALL""",
    "q16": f"""
SELECT max_installments, {round2(average(money("total_payment")))} AS avg_order_value,
  COUNT(*) AS total_orders
FROM dl WHERE payment_type = 'credit_card' AND max_installments >= 1 AND max_installments <= 10
GROUP BY ALL""",
    "b1": f"""
SELECT voucher_user, COUNT(*) FILTER (n > 1) AS repeat_customers, COUNT(*) AS total_customers,
  {percent("COUNT(*) FILTER (n > 1)", "COUNT(*)")} AS repeat_rate_pct
FROM (SELECT IF({BY_VOUCHER} > 0, 'Voucher User', 'Non-Voucher') AS voucher_user,
        COUNT(DISTINCT order_id) AS n
      FROM dl GROUP BY customer_unique_id)
GROUP BY ALL""",
    "b2": f"""
SELECT IF(payment_type = 'voucher', 'With Voucher', 'Without Voucher') AS voucher_group,
  {round2(average(money("total_payment")))} AS avg_order_value, COUNT(*) AS total_orders
FROM dl GROUP BY ALL""",
    "b3": f"""
SELECT segment, {BY_VOUCHER} AS voucher_orders, COUNT(*) AS total_orders,
  {percent(BY_VOUCHER, "COUNT(*)")} AS voucher_pct
FROM so GROUP BY ALL""",
    "q5": f"""
SELECT customer_state, {total("total_payment")} AS hv_revenue
FROM so WHERE total_spent >= 200 GROUP BY ALL ORDER BY hv_revenue DESC, customer_state LIMIT 8""",
    "q6": f"""
SELECT customer_state, {HV_ROWS} AS hv_count, COUNT(*) AS total_count,
  {percent(HV_ROWS, "COUNT(*)")} AS hv_pct
FROM cs GROUP BY ALL ORDER BY hv_pct DESC, customer_state LIMIT 15""",
    "q17": f"""
SELECT customer_state,
  IFNULL(CAST(SUM({money("total_spent")}) FILTER (total_spent >= 200) AS DOUBLE), 0) AS hv_revenue,
  {percent(HV_ROWS, "COUNT(*)")} AS hv_concentration_pct, COUNT(*) AS total_customers
FROM cs GROUP BY ALL HAVING COUNT(*) >= 50""",
    "q17_5": regional(500000, 200000, 3),
    "q15": f"SELECT {total('total_payment')} AS total_revenue_at_risk FROM rl",
    "q7": f"""
SELECT 'Voucher at Risk' AS label, {total("total_payment")} AS value
FROM rl WHERE payment_type = 'voucher' AND order_status = 'canceled'
UNION ALL SELECT 'Total Revenue', {total("total_payment")} FROM dl""",
    "q7a": f"""
SELECT {total("total_payment")} AS voucher_canceled_value
FROM rl WHERE payment_type = 'voucher' AND order_status = 'canceled'""",
    "q7b": f"""
SELECT {percent("lost", "gained")} AS pct_of_hv_revenue
FROM (SELECT {total("total_payment")} AS lost
      FROM rl WHERE payment_type = 'voucher' AND order_status = 'canceled'),
  (SELECT SUM({money("total_payment")}) AS gained FROM so WHERE total_spent >= 200)""",
    "q8": cancel_rate("payment_type"),
    "q8_5": f"""
SELECT payment_type, n AS cancelled_orders, CAST(lost AS DOUBLE) AS revenue_lost,
  {round2("CAST(lost AS DOUBLE) / n_rows")} AS avg_lost_per_order,
  {percent("lost", "SUM(lost) OVER ()")} AS pct_of_total_lost
FROM (SELECT payment_type, COUNT(DISTINCT order_id) AS n, COUNT(*) AS n_rows,
        SUM({money("total_payment")}) AS lost
      FROM rl WHERE order_status = 'canceled' GROUP BY ALL)""",
    "a1": cancel_rate(f"payment_type, {VALUE_RANGES} AS value_range", "canceled", "total"),
    "a4": cancel_rate("customer_state") + " ORDER BY cancel_rate_pct DESC, customer_state LIMIT 15",
    "c1": f"""
SELECT category, COUNT(*) AS total_orders, {round2(average(money("price")))} AS avg_price
FROM p_order_items_products JOIN dl USING (order_id)
WHERE price >= 150 AND payment_type = 'credit_card' AND max_installments = 1
GROUP BY ALL ORDER BY COUNT(*) DESC, category LIMIT 10""",
    "c3": f"""
SELECT COUNT(DISTINCT customer_id) AS near_threshold_cc_1x_customers, COUNT(*) AS total_orders,
  {round2(average(money("total_payment")))} AS avg_order_value
FROM so WHERE total_spent >= 150 AND total_spent <= 200 AND payment_type = 'credit_card'
  AND max_installments = 1""",
    "q21": """
SELECT 'Convert ' || share || '%' AS scenario,
  ROUND(CAST(n * share AS DOUBLE) * 200 / 100, 2) AS projected_revenue
FROM (VALUES (10), (25), (50), (100)) AS v(share),
  (SELECT COUNT(*) AS n FROM cs WHERE total_spent >= 150 AND total_spent <= 200)""",
}

INGEST = {
    "ingest_status_distribution": """
SELECT order_status, COUNT(*) AS orders FROM src_orders
WHERE order_status IS NOT NULL GROUP BY ALL""",
    "ingest_valid_payments": """
SELECT order_id, payment_sequential, payment_type, payment_installments,
  CAST(payment_value AS DOUBLE) AS payment_value
FROM payments""",
    "ingest_counts": """
SELECT 'orders' AS source, COUNT(*) AS rows_read, COUNT(*) AS rows_kept FROM src_orders
UNION ALL SELECT 'payments', (SELECT COUNT(*) FROM all_payments), (SELECT COUNT(*) FROM payments)
UNION ALL SELECT 'customers', COUNT(*), COUNT(*) FROM customers
UNION ALL SELECT 'items', COUNT(*), COUNT(*) FROM items
UNION ALL SELECT 'sellers', COUNT(*), COUNT(*) FROM sellers
UNION ALL SELECT 'products', COUNT(*), COUNT(*) FROM products
UNION ALL SELECT 'categories', COUNT(*), COUNT(*) FROM categories""",
}

LOAD_REPORT = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", COUNT(*) AS rows FROM {name}" for name in COLUMNS
)


# Payments of four decimals, for the same marts.
FINE_PREFIX = PREFIX.replace(
    "FLOOR(l_extendedprice / 10) / 100 AS payment_value",
    "ROUND(l_extendedprice * (1 - l_discount), 4) AS payment_value",
)
FINE = ("fact_payments", "customer_segments", "revenue_by_state")
NEED_OPTIONAL = ("order_items_products", "seller_orders")


def statements() -> dict[str, str]:
    bodies = {f"mart_{name}": f"SELECT * FROM {name}" for name in COLUMNS}
    for prefix, suffix in (("publish_", "_normalized"), ("publish_table_", ""), ("job_table_", "")):
        bodies |= {f"{prefix}{name}{suffix}": f"SELECT * FROM p_{name}" for name in COLUMNS}
    bodies |= {f"report_{key}": sql for key, sql in REPORTS.items()}
    bodies["report_q17_5_tuned"] = regional(110000, 90000, 8)
    bodies |= INGEST
    for place in (
        "publish_seller_orders_appended",
        "publish_table_seller_orders_appended",
        "publish_table_seller_orders_appended_once",
    ):
        bodies[place] = "SELECT * FROM p_seller_orders UNION ALL SELECT * FROM p_seller_orders"
    bodies["mart_order_items_products_untranslated"] = """
SELECT order_id, product_id, seller_id, price, freight_value, product_category_name AS category
FROM items LEFT JOIN products USING (product_id)"""
    bodies["job_load_report"] = LOAD_REPORT
    bodies["job_landed_payments"] = INGEST["ingest_valid_payments"]
    bodies["job_ingest_counts"] = INGEST["ingest_counts"]
    bodies["job_ingest_statuses"] = INGEST["ingest_status_distribution"]
    bodies["job_partial_revenue_by_state"] = "SELECT * FROM p_revenue_by_state"
    bodies["job_partial_tables"] = " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", COUNT(*) AS rows FROM {name}"
        for name in COLUMNS
        if name not in NEED_OPTIONAL
    )
    found = {name: PREFIX + body.strip() for name, body in bodies.items()}
    for name in FINE:
        found[f"mart_{name}_fine"] = FINE_PREFIX + f"SELECT * FROM {name}"
    found["report_q2_fine"] = FINE_PREFIX + REPORTS["q2"].strip()
    return found
