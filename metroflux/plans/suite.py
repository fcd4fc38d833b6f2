"""The model test suite: 72 column tests and 4 singular tests (76 in all).

Declared as data so the same list drives the Spark runner and the SQL oracle.
"""

from __future__ import annotations

from metroflux.operators.quality import Test
from metroflux.schemas import (BOROUGHS, DEMAND_CATEGORY_VALUES, DIM_TIME_OF_DAY, DISTANCE_BUCKETS,
                               DURATION_BUCKETS, PRECIPITATION_TYPES, TRIP_TIME_OF_DAY,
                               WEATHER_SEVERITIES)


def _nn(model, *cols):
    return [Test(f"not_null_{model}_{c}", model, "not_null", c) for c in cols]


def _uq(model, col):
    return [Test(f"unique_{model}_{col}", model, "unique", col)]


def _acc(model, col, values):
    return [Test(f"accepted_values_{model}_{col}", model, "accepted_values", col, list(values))]


def suite() -> list[Test]:
    t: list[Test] = []
    # sources (8)
    t += _nn("trips_raw", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID")
    t += _nn("weather_raw", "datetime_hour") + _uq("weather_raw", "datetime_hour")
    t += _nn("alerts_raw", "alert_id", "subway_line")
    # staging (15)
    t += _nn("stg_trips", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
             "dropoff_location_id", "trip_duration_minutes", "fare_amount", "trip_distance_miles")
    t += _nn("stg_weather", "weather_datetime") + _uq("stg_weather", "weather_datetime")
    t += _nn("stg_weather", "weather_severity") + _acc("stg_weather", "weather_severity", WEATHER_SEVERITIES)
    t += _nn("stg_alerts", "alert_id", "subway_line", "disruption_severity_score")
    t += _acc("stg_alerts", "disruption_severity_score", [0, 1, 2, 3, 4, 5])
    # intermediate (17)
    t += _nn("trips_weather", "pickup_datetime", "pickup_location_id")
    t += _acc("trips_weather", "weather_severity", WEATHER_SEVERITIES)
    for col, vals in [("trip_duration_bucket", DURATION_BUCKETS), ("trip_distance_bucket", DISTANCE_BUCKETS),
                      ("time_of_day", TRIP_TIME_OF_DAY)]:
        t += _nn("trip_metrics", col) + _acc("trip_metrics", col, vals)
    t += _nn("trip_metrics", "is_peak_hour", "tip_percentage", "avg_speed_mph")
    t += _nn("demand_zone_hour", "pickup_date", "pickup_hour", "pickup_location_id", "trip_count",
             "total_fare_revenue")
    # marts (32)
    t += _nn("dim_location", "location_id") + _uq("dim_location", "location_id")
    t += _nn("dim_location", "borough") + _acc("dim_location", "borough", BOROUGHS)
    t += _nn("dim_location", "zone_name")
    t += _nn("dim_location", "demand_category") + _acc("dim_location", "demand_category", DEMAND_CATEGORY_VALUES)
    t += _nn("dim_time", "datetime_hour") + _uq("dim_time", "datetime_hour")
    t += _nn("dim_time", "time_of_day") + _acc("dim_time", "time_of_day", DIM_TIME_OF_DAY)
    t += _nn("dim_time", "is_weekend", "is_holiday_period")
    t += _nn("dim_weather", "weather_datetime") + _uq("dim_weather", "weather_datetime")
    t += _nn("dim_weather", "weather_severity") + _acc("dim_weather", "weather_severity", WEATHER_SEVERITIES)
    t += _nn("dim_weather", "weather_impact_score") + _acc("dim_weather", "weather_impact_score", [1, 2, 3, 4, 5])
    t += _nn("dim_weather", "precipitation_type") + _acc("dim_weather", "precipitation_type", PRECIPITATION_TYPES)
    t += _nn("fact_trips", "trip_id") + _uq("fact_trips", "trip_id")
    t += _nn("fact_trips", "pickup_datetime", "pickup_location_id", "dropoff_location_id", "pickup_borough",
             "fare_amount", "total_amount", "trip_duration_minutes", "has_subway_disruption",
             "weather_severity")
    # singular (4)
    t += [Test("valid_location_ids", "fact_trips", "orphans",
               ref=("dim_location", "pickup_location_id", "location_id")),
          Test("weather_coverage", "fact_trips", "expression", where="weather_severity is null"),
          Test("trip_amount_consistency", "fact_trips", "expression", severity="warn",
               where="total_amount < fare_amount"),
          Test("trip_duration_vs_distance", "fact_trips", "expression", severity="warn",
               where="trip_distance_miles > 100 and trip_duration_minutes < 30")]
    return t


def models_of(p) -> dict:
    """The models a suite run needs, from a Pipeline."""
    return {
        "trips_raw": p.trips_raw, "weather_raw": p.weather_raw, "alerts_raw": p.alerts_raw,
        "stg_trips": p.stg_trips, "stg_weather": p.stg_weather, "stg_alerts": p.stg_alerts,
        "trips_weather": p.trips_weather, "trip_metrics": p.trip_metrics,
        "demand_zone_hour": p.demand_zone_hour, "dim_location": p.dim_location, "dim_time": p.dim_time,
        "dim_weather": p.dim_weather, "fact_trips": p.fact_trips,
    }
