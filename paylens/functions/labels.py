"""Predicates and labels on published columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylens import constants as C


def delivered() -> Column:
    return F.col("order_status") == C.DELIVERED


def canceled() -> Column:
    return F.col("order_status") == C.CANCELED


def paid_by(payment_type: str) -> Column:
    return F.col("payment_type") == payment_type


def single_installment() -> Column:
    return F.col("max_installments") == 1


def high_value() -> Column:
    return F.col("total_spent") >= float(C.HIGH_MIN)


def near_threshold() -> Column:
    return F.col("total_spent").between(float(C.NEAR_MIN), float(C.NEAR_MAX))


def segment(spent: Column, high: float = C.HIGH_MIN, premium: float = C.PREMIUM_MIN) -> Column:
    return F.when(spent >= premium, C.PREMIUM).when(spent >= high, C.HIGH).otherwise(C.REGULAR)


def binned(value: Column, bins: Sequence[tuple[float | None, str]]) -> Column:
    """Label of the first bin whose exclusive upper edge is above the value."""
    *closed, (_, open_label) = bins
    labels = [F.when(value < float(edge), label) for edge, label in closed]
    return F.coalesce(*labels, F.lit(open_label))


def spending_bin() -> Column:
    """Lower edge of the value's bin."""
    width = C.SPENDING_BIN_WIDTH
    return (F.floor(F.col("total_spent") / width) * width).cast("double")
