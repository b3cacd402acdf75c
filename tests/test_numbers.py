"""Sums do not depend on order and lose no digits; rounding is that of the decimals as written."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from larder.functions.numbers import exact_avg, exact_sum, merged_parts, parts_rounded, parts_value, rounded, rounded_sum, sum_parts


def one(spark, values, column):
    return spark.createDataFrame([(x,) for x in values], "v double").repartition(3).select(column).first()[0]


def v():
    return F.col("v")


def test_small_and_great_addends(spark):
    for values in ([3e-7] * 1000, [1e21, 1.5, -1e21], [0.1] * 10, [1e300, 1.0, -1e300], [2.0**53, 1.0, 1.0, -(2.0**53)], [5e-324] * 7):
        assert one(spark, values, exact_sum(v())) == math.fsum(values)
    assert one(spark, [1e-20] * 10 + [None], exact_sum(v())) == pytest.approx(1e-19, rel=1e-12)
    assert one(spark, [1e21] * 3, rounded_sum(v(), 2)) == 3e21
    assert one(spark, [1.0, 2.0, None], exact_avg(v())) == 1.5
    assert one(spark, [None], exact_sum(v())) is None and one(spark, [None], rounded_sum(v(), 2)) is None


@pytest.mark.parametrize("seed", range(3))
def test_any_order_gives_the_same_bits(spark, seed):
    r = random.Random(seed)
    values = [r.choice([1, -1]) * r.random() * 10.0 ** r.randint(-12, 11) for _ in range(3000)] + [r.random() * 10.0 ** r.randint(12, 20) for _ in range(50)]
    seen = set()
    for _ in range(3):
        r.shuffle(values)
        seen.add(one(spark, values, exact_sum(v())))
    assert len(seen) == 1 and seen.pop() == pytest.approx(math.fsum(values), rel=1e-15)


@pytest.mark.parametrize("values", [[float("inf"), 1.0], [float("-inf"), 1e40], [float("nan"), 1.0], [float("inf"), float("-inf")], [1e308, 1e308], [None, float("inf")]])
def test_endless_and_undefined_values_are_those_of_sum(spark, values):
    got, want = one(spark, values, exact_sum(v())), one(spark, values, F.sum(v()))
    assert got == want or (got != got and want != want)
    got, want = one(spark, values, exact_avg(v())), one(spark, values, F.avg(v()))
    assert got == want or (got != got and want != want)


@pytest.mark.parametrize(
    "value, places, want",
    [(2.6749996, 2, 2.67), (19.9949997, 2, 19.99), (0.0049999996, 2, 0.0), (12.49999996, 0, 12.0), (2.675, 2, 2.68), (-2.675, 2, -2.68), (-0.001, 2, 0.0)],
)
def test_rounds_once(spark, value, places, want):
    for column in (rounded(v(), places), rounded_sum(v(), places)):
        assert str(one(spark, [value], column)) == str(want)


def test_sums_of_sums(spark):
    rows = spark.createDataFrame([(k % 3, k * 0.1 + 1e-9) for k in range(99)], "k int, v double")
    parts = rows.groupBy("k").agg(sum_parts(v()).alias("p"))
    want = rows.select(exact_sum(v()), rounded_sum(v(), 3)).first()
    assert parts.select(parts_value(merged_parts(F.col("p"))), parts_rounded(merged_parts(F.col("p")), 3)).first() == want
