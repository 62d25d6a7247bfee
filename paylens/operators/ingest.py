"""Checks and cleaning of the raw sources."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paylens import constants as C
from paylens.functions.figures import fits
from paylens.operators.publish import write_parquet
from paylens.schemas import MONEY_SCALE, SourceSpec


def status_distribution(orders: DataFrame) -> DataFrame:
    """Orders per status, most frequent first; rows without a status are left out."""
    return (
        orders.where(F.col("order_status").isNotNull())
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(F.desc("orders"), "order_status")
    )


def is_valid_payment():
    """True for every type but the invalid one, so also for a missing type."""
    return ~F.col("payment_type").eqNullSafe(C.INVALID_PAYMENT)


def valid_payments(payments: DataFrame) -> DataFrame:
    return payments.where(is_valid_payment())


def source_counts(sources: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows read and rows kept per source that is present."""

    def counts(name: str, df: DataFrame) -> DataFrame:
        read = F.count(F.lit(1))
        kept = F.count_if(is_valid_payment()) if name == "payments" else read
        return df.agg(
            F.lit(name).alias("source"), read.alias("rows_read"), kept.alias("rows_kept")
        )

    parts = [counts(name, df) for name, df in sources.items() if df is not None]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Landed:
    """Rows read and kept, and for orders the rows per status, most frequent first."""

    rows_read: int
    rows_kept: int
    statuses: dict[str, int] | None = None


# Statuses counted while landing, and those held at a time; with more, a second job counts them.
MOST_STATUSES, HELD_STATUSES = 1_000, 10_000


def _statuses(top: list, n: int, spark: SparkSession, path: str) -> dict[str, int]:
    """Orders per status from the most frequent ones counted while writing.

    They are all, and exact, if they add up to the rows: making room takes an equal part off at least 3/8
    of the statuses held, so more than is added back to the fewer ones in the list.
    """
    if sum(r["count"] for r in top) != n:
        counted = status_distribution(spark.read.parquet(path)).collect()
        return {r["order_status"]: r["orders"] for r in counted}
    found = [(r["item"], r["count"]) for r in top if r["item"] is not None]
    return dict(sorted(found, key=lambda x: (-x[1], x[0])))


def land(df: DataFrame, spec: SourceSpec, path: str) -> Landed:
    """Write a source as Parquet, payments without the invalid ones.

    Rows, and orders per status, are counted and amounts checked while they are written. Amounts with
    more decimals than sums are exact to fail the landing with their number; nothing is rounded, and
    what was landed before stays.
    """
    seen = Observation()
    figures = [F.count_if(~fits(F.col(c))).alias(c) for c in spec.money]
    if spec.name == "orders":
        counted = F.expr(f"approx_top_k(order_status, {MOST_STATUSES}, {HELD_STATUSES})")
        figures.append(counted.alias("statuses"))
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows_read"), *figures)
    kept = valid_payments(watched) if spec.name == "payments" else watched

    def check() -> None:
        for column in spec.money:
            if n := seen.get[column]:
                raise ValueError(
                    f"{spec.name}: {n} amounts in {column} do not fit {MONEY_SCALE} decimals"
                )

    rows = write_parquet(kept, path, check=check)
    statuses = None
    if spec.name == "orders":
        statuses = _statuses(seen.get["statuses"], seen.get["rows_read"], df.sparkSession, path)
    return Landed(seen.get["rows_read"], rows, statuses)
