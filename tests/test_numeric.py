"""Exact sums of doubles against whole-number arithmetic in Python."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from metroflux.functions import numeric as nm


def nearest(values):
    return float(sum(map(Fraction, values), Fraction(0)))


CASES = {
    "miles": [round(random.Random(1).uniform(0, 40), d) for d in (3, 5, 2) for _ in range(300)],
    "cancelling": [1e13, 0.1, -1e13, 1e-9, -0.1, 3e12, -3e12] * 5,
    "tenths": [0.1] * 1000,
    "mixed signs": [(-1) ** i * random.Random(i).uniform(0, 10 ** random.Random(i).randint(-6, 12)) for i in range(500)],
    "large": [2.0 ** 44 - 1, -(2.0 ** 43) + 0.5, 2.0 ** 43 + 2.0 ** -8] * 40,
    "beyond 2^50": [2.0 ** 60, 2.0 ** 52 + 1, -3.5],
    "ties": [2.0 ** 44, 2.0 ** -9, 2.0 ** -70],
    "negative": [-0.1, -0.2, -1e-20, -7.25],
    "one": [-0.3],
    "zero": [0.0, -0.0],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("parts", [1, 7])
def test_sum_is_the_double_nearest_to_the_true_sum(spark, name, parts):
    values = CASES[name] + [None]
    random.Random(parts).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    row = df.agg(nm.exact_sum("x").alias("s"), nm.exact_mean("x").alias("m")).first()
    # every case but the last-bit ones is a multiple of 2^-75
    assert row.s == nearest(CASES[name])
    assert row.m == nearest(CASES[name]) / len(CASES[name])


def test_states_merge_to_the_same_bits(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(4), rng.randrange(50), rng.uniform(-1e6, 1e6)) for _ in range(3000)] + [(1, 1, None), (9, 1, None)]
    df = spark.createDataFrame(rows, "g int, fine int, x double").repartition(5)
    states = df.groupBy("g", "fine").agg(*nm.state("x", "x"))
    got = {r.g: (r.s, r.m) for r in states.groupBy("g").agg(*nm.merge("x")).select("g", nm.total("x").alias("s"), nm.mean("x").alias("m")).collect()}
    for g in (*range(4), 9):
        xs = [x for h, _, x in rows if h == g and x is not None]
        assert got[g] == ((nearest(xs), nearest(xs) / len(xs)) if xs else (None, None))


def test_values_outside_the_limbs(spark):
    def total(*values):
        return spark.createDataFrame([(float(v),) for v in values], "x double").agg(nm.exact_sum("x").alias("s")).first().s
    assert total(1e300, 1.5) == 1e300
    assert total("inf", 1.0) == math.inf and math.isnan(total("inf", "-inf")) and math.isnan(total("nan", 1.0))
    assert total("inf") == math.inf
    assert total(2.0 ** -80, 2.0 ** -80) == 2.0 ** -79


def test_round_halves_at_the_decimal_text(spark):
    df = spark.createDataFrame([(10.01,), (10.02,)], "x double")
    assert df.agg(nm.mean_rounded("x", 2).alias("m")).first().m == 10.02
    rows = [(1.005,), (2.675,), (-1.005,), (1.0049999,)]
    got = [r.h for r in spark.createDataFrame(rows, "x double").select(nm.hundredths("x").alias("h")).collect()]
    assert got == [100, 268, -100, 100]  # the product with 100 decides: 1.005 * 100 is 100.49999999999999


def test_exact_text_tells_all_doubles_of_a_measure_apart(spark):
    values = [0.1, 0.1 + 2 ** -55, 12.345, 12.34500000000001, -0.5, 0.5, 3.0, -3.0, 0.0, 1e6 + 0.01]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    texts = [r.t for r in df.select(nm.exact_text("x").alias("t")).collect()]
    assert len(set(texts)) == len(values)
    for v, t in zip(values, texts, strict=True):
        whole, part = t.split(":")
        assert Fraction(int(whole)) + Fraction(int(part), 2 ** 60) == Fraction(v)


def test_three_and_five_decimal_miles_average_as_raw_doubles(spark):
    from metroflux.operators.demand import BASIC_KEYS, demand_basic
    miles = [1.234, 0.00517, 2.005, 7.12345, 3.14159]
    rows = [("2024-01-01", 5, 7, m, 10.0 + m) for m in miles]
    df = spark.createDataFrame(rows, "pickup_date string, pickup_hour long, pickup_location_id long, trip_distance_miles double, fare_amount double")
    answers = {df.repartition(n).groupBy(*BASIC_KEYS).agg(nm.mean_rounded("trip_distance_miles", 5).alias("m")).first().m for n in (1, 2, 5)}
    assert answers == {round(sum(map(Fraction, miles)) / 5 * 10 ** 5) / 10 ** 5}
    assert demand_basic(df).first().total_fare_revenue == nearest([10.0 + m for m in miles])
