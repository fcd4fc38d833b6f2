"""Zone-hour demand roll-up of enriched trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.functions.numeric import exact_sum, mean_rounded, mean_rounded_int

DEMAND_KEYS = [
    "pickup_date", "pickup_hour", "pickup_location_id", "is_weekend", "time_of_day",
    "weather_severity", "has_snowfall", "has_precipitation", "is_below_freezing",
    "temperature_celsius", "precipitation_mm", "snowfall_cm",
]

BASIC_KEYS = ["pickup_date", "pickup_hour", "pickup_location_id"]


def demand_measures() -> list:
    """Volume, rounded averages, revenue and conditional counts."""
    return [
        F.count(F.lit(1)).alias("trip_count"),
        mean_rounded("fare_amount", 2).alias("avg_fare"),
        mean_rounded("total_amount", 2).alias("avg_total_amount"),
        mean_rounded_int("trip_duration_minutes", 1).alias("avg_duration_minutes"),
        mean_rounded("trip_distance_miles", 2).alias("avg_distance_miles"),
        mean_rounded("tip_percentage", 2).alias("avg_tip_percentage"),
        mean_rounded("avg_speed_mph", 2).alias("avg_speed_mph"),
        exact_sum("fare_amount").alias("total_fare_revenue"),
        F.count_if(F.col("is_peak_hour")).alias("peak_hour_trips"),
        F.count_if(F.col("is_snow_trip")).alias("snow_trip_count"),
        F.count_if(F.col("is_rain_trip")).alias("rain_trip_count"),
        F.count_if(F.col("payment_type") == 1).alias("card_payment_count"),
        F.count_if(F.col("payment_type") == 2).alias("cash_payment_count"),
    ]


def demand_zone_hour(metrics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per zone, date, hour (and the weather of that hour).

    A hash aggregate with map-side partial aggregation: each task reduces its
    trips to zone-hour partials before the shuffle, so even a zone holding a
    third of all trips sends one partial row per task and hour.
    """
    keys = keys or DEMAND_KEYS
    return metrics.groupBy(*keys).agg(*demand_measures())


def demand_basic(trips: DataFrame) -> DataFrame:
    """Trips per pickup zone and hour from staged trips, without weather."""
    return trips.groupBy(*BASIC_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        mean_rounded("fare_amount", 2).alias("avg_fare"),
        exact_sum("fare_amount").alias("total_fare_revenue"),
    )
