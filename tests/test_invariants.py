"""Pipeline-level invariants on the supplied tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from metroflux.plans.catalog import pipeline


def test_rollup_and_joins_keep_rows(spark):
    p = pipeline(spark, SF_CHECK)
    staged = p.stg_trips.count()
    assert staged == 6351
    assert p.trips_weather.count() == staged                       # left join keeps every trip
    assert p.demand_zone_hour.agg(F.sum("trip_count")).first()[0] == staged
    fact = p.fact_trips
    assert fact.count() == staged
    assert fact.select("trip_id").distinct().count() == staged
    assert p.subway_impact.count() == p.demand_zone_hour.count()


def test_asserted_dimensions_give_same_fact(spark):
    a = pipeline(spark, SF_SMALL).fact_trips
    b = pipeline(spark, SF_SMALL, assert_unique=True).fact_trips
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def _doubled_weather(spark, **kw):
    p = pipeline(spark, SF_SMALL, **kw)
    p.weather_raw = p.weather_raw.unionByName(p.weather_raw)
    return p


def test_repeated_weather_hours_fan_out_and_the_fact_keeps_one_row(spark):
    p = _doubled_weather(spark)
    without = pipeline(spark, SF_SMALL).trips_weather.where("weather_datetime is null").count()
    assert p.stg_trips.count() == 632 and p.trips_weather.count() == 2 * 632 - without and without < 50
    assert p.fact_trips.count() == 632


def test_asserted_dimensions_name_the_repeated_key(spark):
    with pytest.raises(Exception, match="weather_date, weather_hour occurs more than once"):
        _doubled_weather(spark, assert_unique=True).trips_weather.count()


def test_refresh_with_a_narrower_window_leaves_no_old_dates(spark, tmp_path):
    root = str(tmp_path / "m")
    pipeline(spark, SF_SMALL).materialize(root, tables=["trip_metrics"])
    f = pipeline(spark, SF_SMALL)
    f.bounds["window_end"] = "2024-01-04 00:00:00"
    want = f.trip_metrics.count()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        f.materialize(root, tables=["trip_metrics"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert 0 < want < 632 and spark.read.parquet(f"{root}/trip_metrics").count() == want


def test_across_midnight_expands_more_hours(spark):
    base = pipeline(spark, SF_CHECK).hourly_disruptions.agg(F.sum("moderate_alert_count")).first()[0]
    wide = pipeline(spark, SF_CHECK, across_midnight=True).hourly_disruptions.agg(
        F.sum("moderate_alert_count")).first()[0]
    assert wide > base


def test_materialize_round_trip(spark, tmp_path):
    p = pipeline(spark, SF_SMALL)
    before = p.fact_trips.count()
    p.materialize(str(tmp_path / "models"), tables=["trip_metrics", "dim_location", "fact_trips"])
    assert p.fact_trips.count() == before
    assert dict(p.fact_trips.dtypes)["pickup_date"] == "date"
