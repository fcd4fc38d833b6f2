"""Trip enrichment: pickup-hour weather and per-trip derived metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.functions import calendar as cal
from metroflux.functions import classify as cl
from metroflux.functions.numeric import ratio_rounded
from metroflux.operators.quality import require_unique

TRIP_COLUMNS = [
    "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour", "pickup_day_of_week",
    "is_weekend", "pickup_location_id", "dropoff_location_id", "vendor_id", "passenger_count",
    "trip_distance_miles", "trip_duration_minutes", "rate_code_id", "payment_type", "fare_amount",
    "extra_charge", "tip_amount", "tolls_amount", "airport_fee", "total_amount", "cbd_congestion_fee",
    "congestion_surcharge", "improvement_surcharge", "mta_tax",
]
WEATHER_COLUMNS = [
    "weather_datetime", "weather_date", "weather_hour", "temperature_celsius",
    "temperature_fahrenheit", "precipitation_mm", "snowfall_cm", "windspeed_kmh",
    "visibility_metres", "weather_severity", "has_precipitation", "has_snowfall", "is_below_freezing",
]


def join_weather(trips: DataFrame, weather: DataFrame, assert_unique: bool = False) -> DataFrame:
    """Every trip with the weather of its pickup date and hour (left join).

    Weather has a row per hour of the feed, so the planner's byte estimate lets it
    be broadcast and the trips are not shuffled for this join. With duplicate
    weather hours the join fans out, as the source model does; with
    `assert_unique=True` such hours make the query fail and are named.
    """
    w = weather.select(*WEATHER_COLUMNS)
    if assert_unique:
        w = require_unique(w, ["weather_date", "weather_hour"])
    t = trips.select(*TRIP_COLUMNS)
    joined = t.join(w, (t.pickup_date == w.weather_date) & (t.pickup_hour == w.weather_hour), "left")
    return joined.select(*TRIP_COLUMNS, *WEATHER_COLUMNS)


def trip_metrics(df: DataFrame) -> DataFrame:
    """Buckets, time of day, peak flag, tip %, speed, snow/rain flags."""
    return df.select(
        "*",
        cl.duration_bucket("trip_duration_minutes").alias("trip_duration_bucket"),
        cl.distance_bucket("trip_distance_miles").alias("trip_distance_bucket"),
        cal.trip_time_of_day("pickup_hour").alias("time_of_day"),
        cal.is_peak_hour("pickup_hour").alias("is_peak_hour"),
        ratio_rounded("tip_amount", "fare_amount", 2, scale_by=100).alias("tip_percentage"),
        ratio_rounded("trip_distance_miles", "trip_duration_minutes", 2, scale_by=60).alias("avg_speed_mph"),
        cl.is_snow_severity("weather_severity").alias("is_snow_trip"),
        cl.is_rain_severity("weather_severity").alias("is_rain_trip"),
    )
