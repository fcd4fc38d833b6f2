"""Reports from the cube are those from the trips, bit for bit, and read the trips once."""

import random

import pytest
from pyspark.sql import functions as F

from metroflux.operators import cube as cb
from metroflux.operators import reports as rp

SCHEMA = ("pickup_date date, analysis_month string, pickup_hour bigint, time_of_day string, has_subway_disruption boolean, "
          "weather_severity string, is_holiday_period boolean, trip_duration_minutes bigint, fare_amount double, total_amount double, "
          "tip_amount double, tip_percentage double, avg_speed_mph double")


@pytest.fixture(scope="module")
def fact(spark):
    import datetime as dt
    rng = random.Random(3)
    maybe = lambda x: x if rng.random() > 0.05 else None
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60)), rng.choice(["January", None]), rng.randrange(24),
             rng.choice(["off_peak", "late_night"]), rng.random() < 0.3, rng.choice(["clear", "light_rain", None]), rng.random() < 0.2,
             maybe(rng.randrange(1, 90)), maybe(rng.uniform(0, 150)), rng.uniform(-5, 200), rng.uniform(0, 20), maybe(rng.uniform(0, 60)),
             rng.uniform(0, 40)) for _ in range(3000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


@pytest.mark.parametrize("name", ["kpi", "hourly_by_disruption", "fare_by_tod", "trips_by_tod", "monthly_volume", "holiday_split", "disruption_gap"])
def test_report_from_cube_equals_report_from_trips(fact, name):
    assert rows_of(getattr(cb, name)(cb.build_cube(fact))) == rows_of(getattr(rp, name)(fact))


def test_slicers_and_empty(fact):
    cut = {"month": "January", "disrupted": True, "severities": ["light_rain", "clear"]}
    assert rows_of(cb.kpi(rp.slice_by(cb.build_cube(fact), **cut))) == rows_of(rp.kpi(rp.slice_by(fact, **cut)))
    assert rows_of(cb.kpi(cb.build_cube(fact.limit(0)))) == rows_of(rp.kpi(fact.limit(0)))


def test_each_report_reads_the_trips_once(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    fact.write.parquet(path)
    for name in ("kpi", "disruption_gap", "monthly_volume"):
        df = getattr(cb, name)(cb.build_cube(spark.read.parquet(path)))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") == 1


def test_a_coarser_cube_rolls_up_to_the_same(fact):
    cube = cb.build_cube(fact)
    twice = cb.roll_up(cb.roll_up(cube, "time_of_day", "has_subway_disruption", "pickup_hour"), "time_of_day", "has_subway_disruption")
    once = cb.roll_up(cube, "time_of_day", "has_subway_disruption")
    assert rows_of(twice) == rows_of(once)
    assert cube.agg(F.sum("trips")).first()[0] == fact.count()
