from __future__ import annotations

import pytest

from paylens.operators.jobs import together


def test_results_keep_their_order_and_local_properties(spark):
    spark.sparkContext.setLocalProperty("spark.job.description", "all")

    def job(n):
        return lambda: (
            spark.range(n).count(),
            spark.sparkContext.getLocalProperty("spark.job.description"),
        )

    result = together(spark, {str(n): job(n) for n in range(9, 0, -1)})
    assert list(result.items()) == [(str(n), (n, "all")) for n in range(9, 0, -1)]


def test_errors_are_raised(spark):
    with pytest.raises(ZeroDivisionError):
        together(spark, {"good": lambda: 1, "bad": lambda: 1 / 0})


def test_a_table_is_written_once(spark, supplied):
    def ask():
        return supplied.table("seller_orders")

    answers = together(spark, {str(i): ask for i in range(8)})
    assert len({id(df) for df in answers.values()}) == 1
