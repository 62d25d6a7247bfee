"""Row counts, exact money sums and rounded figures.

Amounts are doubles that stand for decimals of at most ``MONEY_SCALE`` places; ingest fails on
any other (``operators/ingest.py``). They are summed as such decimals, so that no digit is lost
and a total does not depend on the order in which partitions are merged. Figures rounded to two
places are rounded as decimals, so that 1.005 is rounded the way it is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.schemas import MONEY_SCALE


def n_rows() -> Column:
    return F.count(F.lit(1))


def exact(name: str) -> Column:
    """The decimal that an amount column stands for."""
    return F.col(name).cast(f"decimal(24,{MONEY_SCALE})")


def fits(value: Column) -> Column:
    """Whether an amount has no more decimals than can be summed; NULL fits."""
    return F.coalesce(value.cast(f"decimal(24,{MONEY_SCALE})").cast("double") == value, F.lit(True))


def amount(decimal: Column) -> Column:
    return decimal.cast("double")


def total(name: str) -> Column:
    """Exact sum of an amount column as a decimal; NULL over no rows."""
    return F.sum(exact(name))


def total_value(name: str) -> Column:
    """Exact sum of an amount column, 0 over no rows."""
    return amount(F.coalesce(total(name), F.lit(0)))


def wide_sum(value: Column) -> Column:
    """Sum of whole numbers that may leave the range of a bigint."""
    return F.sum(value.cast("decimal(38,0)"))


def mean(sum_: Column, count: Column) -> Column:
    """Unrounded average; NULL over no rows."""
    return F.try_divide(sum_.cast("double"), count.cast("double"))


def mean_amount(name: str) -> Column:
    """Unrounded average of an amount column."""
    return mean(amount(total(name)), F.count(name))


def running_total(df: DataFrame, value: str, order_by: str, slice_by: str) -> DataFrame:
    """The rows with ``so_far``, the sum of a column up to the row, and ``whole``, its total.

    Slices hold neighbouring rows and are numbered in order. Each is summed first; the sums, one row per
    slice, give what comes before a slice, and the running sums are taken inside the slices.
    """
    earlier = Window.orderBy(slice_by).rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        df.groupBy(slice_by)
        .agg(F.sum(value).alias("held"))
        .select(
            slice_by,
            F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
            F.sum("held").over(Window.partitionBy()).alias("whole"),
        )
    )
    inside = Window.partitionBy(slice_by).orderBy(order_by)
    return (
        df.withColumn("inside", F.sum(value).over(inside))
        .join(slices, slice_by)
        .withColumn("so_far", F.col("before") + F.col("inside"))
        .drop("before", "inside")
    )


def round2(value: Column) -> Column:
    return F.round(value.cast("decimal(28,10)"), 2).cast("double")


def mean_value(name: str) -> Column:
    """Average of an amount column, rounded to two places."""
    return round2(mean_amount(name))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded to two places; NULL if whole is 0."""
    return round2(F.try_divide(part.cast("double") * 100, whole.cast("double")))
