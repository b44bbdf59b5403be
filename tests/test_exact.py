"""Means that are the same for every order and partitioning."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.trip_rows import bronze, zones
from tripstrata.functions.exact import exact_mean
from tripstrata.plans.layers import build_gold, build_silver


def mean(spark, values, parts=3):
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return rows.agg(exact_mean(F.col("x")).alias("m")).first().m


def test_the_mean_is_that_of_the_exact_sum(spark):
    pick = random.Random(4)
    for scale in (1.0, 1e-3, 2000.0, 1e6):
        values = [pick.uniform(0, scale) for _ in range(500)] + [scale / 3] * 50
        want = float(sum(map(Fraction, values)) / len(values))
        assert mean(spark, values) == pytest.approx(want, rel=3e-16)


def test_order_and_partitions_do_not_matter(spark):
    pick = random.Random(5)
    values = [pick.uniform(0, 10.0 ** pick.randint(-6, 6)) for _ in range(2000)]
    found = {mean(spark, pick.sample(values, len(values)), parts) for parts in (1, 2, 7, 16)}
    assert len(found) == 1


def test_odd_values(spark):
    assert mean(spark, [None, None]) is None and mean(spark, []) is None
    assert mean(spark, [-1.5, -2.25, None]) == -1.875
    assert mean(spark, [0.0, 5e-324]) == 0.0
    assert mean(spark, [1e300, 3e300]) == 2e300
    assert str(mean(spark, [float("nan"), 1.0])) == "nan"
    assert mean(spark, [float("inf"), 1.0]) == float("inf")


def test_gold_has_the_same_bits_for_any_partitioning(spark):
    pick = random.Random(6)
    rows = [
        {"fare_amount": float(n), "trip_distance": pick.uniform(0.1, 30), "PULocationID": n % 2 + 1}
        for n in range(400)
    ]
    lookup = zones(spark, (1, "North"), (2, "South"))
    found = set()
    for parts in (1, 5, 16):
        pick.shuffle(rows)
        gold = build_gold(build_silver(bronze(spark, *rows).repartition(parts), lookup))
        found.add(tuple(sorted(tuple(r) for r in gold.collect())))
    assert len(found) == 1
