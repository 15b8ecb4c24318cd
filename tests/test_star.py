"""Adapters: the cheap rounding gives what Spark's own gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vintagemill.sources import star

NUMBERS = [
    *(0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, -0.3, 0.0, -0.0, None),
    *(4503599627370495.5, -4503599627370495.5, 4503599627370497.0, 9007199254740993.0, 1e17, -1e17),
    *(123456.785, 75462.67, -999.995, 16838.005, 5e-324),
    *[sign * n / 8 for n in range(200) for sign in (1, -1)],
]


def test_rounded_is_round(spark, ansi):
    df = spark.createDataFrame([(n,) for n in NUMBERS], "v double")
    found = df.select("v", F.round("v").alias("old"), star._rounded(F.col("v")).alias("new"), star._text(star._rounded(F.col("v"))).alias("text"))
    for v, old, new, text in found.collect():
        assert old == new, v
        assert text == (None if v is None else str(int(old))), v


@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf")])
def test_rounded_leaves_what_is_no_number_to_round(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.where(star._rounded(F.col("v")).eqNullSafe(F.round("v"))).count() == 1


def test_loans_round_each_number_once_and_not_by_decimals(spark, sf_small):
    plan = star.loans(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    rounds = plan.split("round(")[1:]
    assert len(rounds) == 3
    assert plan.count(str(star._EXACT)) == 3 or plan.count("4.503599627370496E15") == 3
