"""The seven sources derived from the supplied star-schema tables.

Orders, customers, items, sellers, products and categories map one to one; every line
item also stands for one payment of its order. Some values are made missing, blank or
invalid on purpose.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylens import constants as C
from paylens.session import work_dir

CUSTOMER_ID_OFFSET = 1_000_000
BLANK_TIME_EVERY = 97


def orders(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    at = F.col("o_orderdate") + F.make_dt_interval(
        hours=(key % 24).cast("int"), mins=(key % 60).cast("int")
    )
    return orders.select(
        key.cast("string").alias("order_id"),
        (key + CUSTOMER_ID_OFFSET).cast("string").alias("customer_id"),
        F.when((status == "P") & (priority == "1-URGENT"), C.CANCELED)
        .when((status == "P") & (priority == "2-HIGH"), C.UNAVAILABLE)
        .when((status == "O") & (priority == "1-URGENT"), "shipped")
        .otherwise(C.DELIVERED)
        .alias("order_status"),
        F.when(key % BLANK_TIME_EVERY == 0, "")
        .otherwise(at.cast("string"))
        .alias("order_purchase_timestamp"),
    )


PAYMENT_ORDER = (
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_shipdate",
    "l_quantity",
)


def payments(lineitem: DataFrame, fine: bool = False) -> DataFrame:
    """Payments numbered by one window per order; ``fine``: amounts of four decimals.

    For marts: where the number is unused, column pruning drops the window, and where only
    payment number 1 is kept, each task keeps one row per order before the shuffle. To get
    all numbers of an order of any size, see ``numbered_payments``.
    """
    lines = lineitem.withColumn("order_id", F.col("l_orderkey").cast("string"))
    number = F.row_number().over(Window.partitionBy("order_id").orderBy(*PAYMENT_ORDER))
    discounted = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return _as_payments(lines, number, F.round(discounted, 4) if fine else None)


# Orders with more lines than this, and more than this part of all lines, are numbered in slices.
LARGE_ORDER, LARGE_PART = 1_000, 1 / 1_000
# Orders counted to find those, and held at a time: enough to miss none of them.
MOST_ORDERS, HELD_ORDERS = 1_000, 10_000


def numbered_payments(lineitem: DataFrame) -> DataFrame:
    """The same payments, of orders of any size, with the rows of most orders moved once.

    One window numbers the orders that fit a task. The few others, found by a count of the most
    frequent ones, are numbered in slices. Rows without an order are left out.
    """
    used = ["l_orderkey", *PAYMENT_ORDER, "l_returnflag", "l_linestatus"]
    lines = lineitem.select(*used).where(F.col("l_orderkey").isNotNull())
    large = _large_orders(lines)
    small = lines.where(~F.col("l_orderkey").isin(large)) if large else lines
    # numbered by the key as it is, which takes less room in a shuffle than its text
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*PAYMENT_ORDER))
    out = _as_payments(_with_order(small.withColumn("number", number)), F.col("number"))
    if large:
        out = out.unionByName(_sliced_payments(lines.where(F.col("l_orderkey").isin(large))))
    return out


def _with_order(lines: DataFrame) -> DataFrame:
    return lines.withColumn("order_id", F.col("l_orderkey").cast("string"))


def _large_orders(lines: DataFrame) -> list[int]:
    """Orders with so many lines that one task should not number them; at most MOST_ORDERS."""
    most = F.expr(f"approx_top_k(l_orderkey, {MOST_ORDERS}, {HELD_ORDERS})").alias("most")
    found = lines.agg(F.count(F.lit(1)).alias("n"), most).first()
    least = max(LARGE_ORDER, found["n"] * LARGE_PART)
    return [r["item"] for r in found["most"] or [] if r["count"] > least]


def _sliced_payments(lineitem: DataFrame) -> DataFrame:
    """Payments with each order numbered in slices.

    A slice is what one task of a range partitioning by order and all columns of PAYMENT_ORDER
    holds of an order, so a very large order is spread over as many tasks as its rows need, even
    if most of them also share a part. The spread rows are written, which fixes the slices; the
    sizes of the earlier slices of an order (one per task at most) give where a slice starts.
    """
    spark = lineitem.sparkSession
    keyed = _with_order(lineitem)
    folder = f"{work_dir(spark)}/numbered-{uuid4().hex}"
    spread = keyed.repartitionByRange("order_id", *PAYMENT_ORDER)
    spread.withColumn("slice", F.spark_partition_id()).write.parquet(folder)
    lines = spark.read.parquet(folder)
    earlier = Window.partitionBy("order_id").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        lines.groupBy("order_id", "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("order_id", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    in_slice = F.row_number().over(Window.partitionBy("order_id", "slice").orderBy(*PAYMENT_ORDER))
    placed = lines.withColumn("in_slice", in_slice).join(starts, ["order_id", "slice"])
    return _as_payments(placed, F.col("start") + F.col("in_slice"))


def _as_payments(lines: DataFrame, number: Column, value: Column | None = None) -> DataFrame:
    value = (F.floor(F.col("l_extendedprice") / 10) / 100) if value is None else value
    line, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    quantity = F.col("l_quantity")
    return lines.select(
        "order_id",
        number.cast("int").alias("payment_sequential"),
        F.when((line == 7) & (flag == "A"), C.INVALID_PAYMENT)
        .when((line == 7) & (flag == "R") & (quantity < 5), F.lit(None))
        .when((flag == "N") & (status == "O"), C.BOLETO)
        .when((flag == "N") & (line <= 3), C.VOUCHER)
        .when(flag == "N", C.DEBIT_CARD)
        .otherwise(C.CREDIT_CARD)
        .alias("payment_type"),
        F.when(flag == "N", 1)
        .otherwise(1 + quantity.cast("int") % 10)
        .alias("payment_installments"),
        value.alias("payment_value"),
    )


def customers(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    buyer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name"
    )
    return orders.join(buyer, F.col("o_custkey") == F.col("c_custkey")).select(
        (F.col("o_orderkey") + CUSTOMER_ID_OFFSET).cast("string").alias("customer_id"),
        F.col("c_custkey").cast("string").alias("customer_unique_id"),
        F.col("n_name").alias("customer_state"),
    )


def items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        (F.floor(F.col("l_extendedprice") / 2) / 100).alias("price"),
        (F.col("l_quantity") / 2).alias("freight_value"),
    )


def sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("seller_id"), F.col("n_name").alias("seller_state")
    )


def products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_size") != 1, F.lower("p_type")).alias("product_category_name"),
    )


def categories(part: DataFrame) -> DataFrame:
    """One category is left untranslated."""
    name = F.lower("p_type")
    return (
        part.where(F.col("p_type") != "ECONOMY")
        .select(
            name.alias("product_category_name"),
            F.concat(F.lit("en_"), name).alias("product_category_name_english"),
        )
        .distinct()
    )


def sources(
    spark: SparkSession, sf_dir: str, all_numbers: bool = False, fine: bool = False
) -> dict[str, DataFrame]:
    """The seven sources; ``all_numbers`` if every payment number will be used."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    order, line, nation, part = table("orders"), table("lineitem"), table("nation"), table("part")
    return {
        "orders": orders(order),
        "payments": numbered_payments(line) if all_numbers else payments(line, fine),
        "customers": customers(order, table("customer"), nation),
        "items": items(line),
        "sellers": sellers(table("supplier"), nation),
        "products": products(part),
        "categories": categories(part),
    }
