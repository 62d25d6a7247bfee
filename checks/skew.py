"""Write larger, skewed copies of the supplied tables: ``python -m checks.skew SF_DIR OUT [COPIES]``.

A third of the line items belongs to one order, a third to one part and one supplier, and a third
of the orders to one customer. Point BENCH_SF_DIR at OUT to time the queries on it.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COPIES = 50
PLAIN = ("region", "nation", "customer", "supplier", "part")


def write_skewed(spark: SparkSession, sf_dir: str, out: str, copies: int = COPIES) -> None:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def third(part: int):
        return F.pmod(F.xxhash64("copy", "l_orderkey", "l_linenumber"), F.lit(3)) == part

    for name in PLAIN:
        table(name).write.mode("overwrite").parquet(f"{out}/{name}.parquet")
    numbers = spark.range(copies).select(F.col("id").alias("copy"))
    top = table("orders").agg(F.max("o_orderkey")).first()[0] + 1
    orders = table("orders").crossJoin(F.broadcast(numbers))  # copies: a given number
    hot_customer = F.pmod(F.xxhash64("copy", "o_orderkey"), F.lit(3)) == 0
    orders.withColumns(
        {
            "o_custkey": F.when(hot_customer, F.lit(1)).otherwise(F.col("o_custkey")),
            "o_orderkey": F.col("o_orderkey") + F.col("copy") * top,
        }
    ).drop("copy").write.mode("overwrite").parquet(f"{out}/orders.parquet")
    lines = table("lineitem").crossJoin(F.broadcast(numbers))
    lines.withColumns(
        {
            "l_partkey": F.when(third(1), F.lit(1)).otherwise(F.col("l_partkey")),
            "l_suppkey": F.when(third(1), F.lit(1)).otherwise(F.col("l_suppkey")),
            "l_orderkey": F.when(third(0), F.lit(1)).otherwise(
                F.col("l_orderkey") + F.col("copy") * top
            ),
        }
    ).drop("copy").write.mode("overwrite").parquet(f"{out}/lineitem.parquet")


if __name__ == "__main__":
    session = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
    write_skewed(session, sys.argv[1], sys.argv[2], int((sys.argv[3:] or [COPIES])[0]))
