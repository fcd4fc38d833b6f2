"""A third of all rows in one group of copies / one hot zone."""

import datetime as dt

from pyspark.sql import functions as F

from metroflux.operators import staging as stg
from metroflux.operators.demand import demand_basic
from metroflux.schemas import FIXTURE_BOUNDS, TRIPS_RAW
from test_plans import plan
from test_units import trip


def _skewed(spark, n=3000):
    hot = [trip() for _ in range(n // 3)]                      # one identity, n/3 exact copies
    rest = [trip(tpep_pickup_datetime=dt.datetime(2024, 1, 10, 8) + dt.timedelta(seconds=i),
                 tpep_dropoff_datetime=dt.datetime(2024, 1, 10, 8, 30) + dt.timedelta(seconds=i),
                 PULocationID=10 if i % 2 else 1 + i % 250)
            for i in range(n - n // 3)]
    return spark.createDataFrame(hot + rest, TRIPS_RAW).repartition(16)


def test_hot_copy_group_collapses_map_side(spark):
    raw = _skewed(spark)
    out = stg.dedupe_trips(raw)
    assert out.count() == 1 + 2000
    # physical tree, root first: Final limit, then the hash exchange, then the Partial limit
    # below it, so each map task sends one row per identity however many copies it holds
    lines = out._jdf.queryExecution().executedPlan().toString().split("\n")
    final = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Final" in l)
    exch = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(tpep_pickup_datetime" in l)
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    assert final < exch < partial


def test_hot_zone_rollup_is_partial_then_final(spark):
    staged = stg.stage_trips(_skewed(spark), FIXTURE_BOUNDS)
    d = demand_basic(staged)
    assert d.agg(F.sum("trip_count")).first()[0] == staged.count()
    p = plan(d)
    assert "partial_count" in p
