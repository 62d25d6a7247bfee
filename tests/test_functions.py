"""Figures against exact arithmetic."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from paylens.functions.figures import (
    amount,
    exact,
    fits,
    mean_value,
    percent,
    total,
    total_value,
)
from paylens.functions.labels import binned, segment
from paylens.functions.time import PURCHASED, hour, iso_weekday, month, quarter

PLACES = Decimal("0.01")


def rounded(value: Fraction) -> float:
    exact = Decimal(value.numerator) / Decimal(value.denominator)
    return float(exact.quantize(PLACES, ROUND_HALF_UP))


def test_percent_is_rounded_exactly(spark):
    pairs = [(a, b) for b in range(1, 160) for a in range(0, b + 1)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for r in df.select("a", "b", percent(F.col("a"), F.col("b")).alias("p")).collect():
        assert r.p == rounded(Fraction(100 * r.a, r.b)), r


def test_percent_of_nothing_is_null(spark):
    df = spark.range(1).select(percent(F.lit(1), F.lit(0)).alias("p"))
    assert df.first().p is None


def test_totals_and_means_are_exact(spark):
    n = 40_000
    rows = [(i * 7919 % 1000, (i * 104729) % 10_000_000) for i in range(n)]
    df = spark.createDataFrame([(k, c / 100) for k, c in rows], "k int, v double")
    expected = {}
    for k, c in rows:
        expected.setdefault(k, []).append(c)
    for parts in (1, 7):
        got = df.repartition(parts).groupBy("k").agg(
            total("v").alias("t"), total_value("v").alias("tv"), mean_value("v").alias("m")
        )
        for r in got.collect():
            values = expected[r.k]
            assert r.t == Decimal(sum(values)) / 100 and r.tv == sum(values) / 100
            assert r.m == rounded(Fraction(sum(values), 100 * len(values)))


@pytest.mark.parametrize("places", [2, 4, 6])
def test_every_decimal_survives(spark, places):
    """Amounts as doubles, back to decimals and out again."""
    df = spark.range(0, 2_000_000_000, 9973).select((F.col("id") / 10**places).alias("v"), "id")
    lost = exact("v") * 10**places != F.col("id")
    changed = amount(exact("v")) != F.col("v")
    assert df.where(lost | changed | ~fits(F.col("v"))).count() == 0


def test_small_amounts_are_not_rounded_away(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert df.agg(total_value("v"), mean_value("v")).first()[0] == 4.0


def test_amounts_that_do_not_fit(spark):
    df = spark.createDataFrame([(0.1234567,), (1e-9,), (0.123456,), (None,)], "v double")
    assert [r[0] for r in df.select(fits(F.col("v"))).collect()] == [False, False, True, True]


def test_empty_total_is_zero(spark):
    df = spark.createDataFrame([], "v double")
    assert tuple(df.agg(total_value("v"), mean_value("v")).first()) == (0.0, None)


def test_bins_and_segments(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 9.99, 10.0, 11.0)], "v double")
    bins = ((1, "a"), (10, "b"), (None, "c"))
    binned_values = df.select(binned(F.col("v"), bins)).collect()
    assert [r[0] for r in binned_values] == ["a", "b", "b", "c", "c"]
    labels = df.select(segment(F.col("v"), high=1, premium=10)).collect()
    assert [r[0] for r in labels] == ["Regular", "High", "High", "Premium", "Premium"]


def test_times_have_one_format(spark):
    from paylens.functions.time import hour, month, quarter

    name = "order_purchase_timestamp"
    good = spark.createDataFrame([("2017-10-02 10:56:33",), ("",), (None,)], f"{name} string")
    parts = good.select(month(), quarter(), hour()).collect()
    assert [tuple(r) for r in parts] == [("2017-10", "Q4-2017", 10), (None,) * 3, (None,) * 3]
    for text in ("2017", "02/10/2017 10:56", "2017-10-02", "2017-13-02 10:56:33"):
        bad = spark.createDataFrame([(text,)], f"{name} string")
        with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
            bad.select(quarter()).collect()


TIMES = {
    "2017-10-02 10:56:33": ("2017-10", "Q4-2017", 1, 10),
    "2016-02-29 23:59:59": ("2016-02", "Q1-2016", 1, 23),
    "2020-06-30 00:00:00": ("2020-06", "Q2-2020", 2, 0),
    "": (None, None, None, None),
    None: (None, None, None, None),
}
NO_TIMES = [
    "2017-10-02", "2017-10-02T10:56:33", "2017-10-02 10:56:33Z", "2017-1-2 10:56:33.1",
    "2017-10-02 10:56:3 ", " 2017-10-2 10:56:33", "2017-02-29 10:00:00", "2017-10-02 24:00:00",
    "2017-13-02 10:56:33", "+201-10-02 10:56:33", "2017-10-02 10:56", "2017/10/02 10:56:33", " ", "x",
    "2017-10-02 10:56:+1", "20a7-10-02 10:56:33",
]


def test_time_parts(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], f"{PURCHASED} string")
    got = df.select(PURCHASED, month(), quarter(), iso_weekday(), hour()).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == TIMES


@pytest.mark.parametrize("text", NO_TIMES)
def test_other_times_raise(spark, text):
    df = spark.createDataFrame([(text,)], f"{PURCHASED} string")
    for part in (month, quarter, iso_weekday, hour):
        with pytest.raises(Exception, match="could not be parsed"):
            df.select(part()).collect()
