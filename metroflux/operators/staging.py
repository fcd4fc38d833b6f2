"""Staging: deduplicate, rename, type and filter the three raw feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflux.functions import calendar as cal
from metroflux.functions.classify import celsius_to_fahrenheit, disruption_score, weather_severity
from metroflux.functions.numeric import hundredths
from metroflux.operators.dedupe import dedupe, total_order
from metroflux.schemas import TRIP_BOUNDS

# the identity of a raw trip; money and miles compared in integer hundredths
TRIP_KEY_COLUMNS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
                    "DOLocationID", "VendorID", "fare_amount", "trip_distance", "passenger_count"]


def trip_identity(without: tuple = ()) -> list[Column]:
    parts = {"tpep_pickup_datetime": F.col("tpep_pickup_datetime"),
             "tpep_dropoff_datetime": F.col("tpep_dropoff_datetime"),
             "PULocationID": F.col("PULocationID"), "DOLocationID": F.col("DOLocationID"),
             "VendorID": F.col("VendorID"), "fare_amount": hundredths("fare_amount"),
             "trip_distance": hundredths("trip_distance"), "passenger_count": F.col("passenger_count")}
    return [c for name, c in parts.items() if name not in without]


def dedupe_trips(raw: DataFrame) -> DataFrame:
    """One raw row per trip identity; survivor = smallest row over the other columns."""
    order = total_order(raw, first=["tpep_pickup_datetime"], exclude=TRIP_KEY_COLUMNS)
    order += [F.col("fare_amount").asc_nulls_first(), F.col("trip_distance").asc_nulls_first()]
    return dedupe(raw, trip_identity(), order)


def standardise_trips(df: DataFrame) -> DataFrame:
    """Readable names, explicit types, duration and pickup calendar."""
    pick, drop = F.col("tpep_pickup_datetime").cast("timestamp_ntz"), F.col("tpep_dropoff_datetime").cast("timestamp_ntz")
    dbl = lambda c: F.col(c).cast("double")
    big = lambda c: F.col(c).cast("bigint")
    return df.select(
        big("VendorID").alias("vendor_id"),
        pick.alias("pickup_datetime"),
        drop.alias("dropoff_datetime"),
        big("PULocationID").alias("pickup_location_id"),
        big("DOLocationID").alias("dropoff_location_id"),
        big("passenger_count").alias("passenger_count"),
        dbl("trip_distance").alias("trip_distance_miles"),
        big("RatecodeID").alias("rate_code_id"),
        F.col("store_and_fwd_flag").alias("store_and_forward_flag"),
        big("payment_type").alias("payment_type"),
        dbl("fare_amount").alias("fare_amount"),
        dbl("extra").alias("extra_charge"),
        dbl("mta_tax").alias("mta_tax"),
        dbl("tip_amount").alias("tip_amount"),
        dbl("tolls_amount").alias("tolls_amount"),
        dbl("improvement_surcharge").alias("improvement_surcharge"),
        dbl("congestion_surcharge").alias("congestion_surcharge"),
        dbl("Airport_fee").alias("airport_fee"),
        dbl("cbd_congestion_fee").alias("cbd_congestion_fee"),
        dbl("total_amount").alias("total_amount"),
        cal.minutes_between(pick, drop).alias("trip_duration_minutes"),
        F.to_date(pick).alias("pickup_date"),
        F.hour(pick).cast("bigint").alias("pickup_hour"),
        cal.day_of_week(pick).alias("pickup_day_of_week"),
        cal.is_weekend(pick).alias("is_weekend"),
    )


def valid_trip(bounds: dict | None = None) -> Column:
    """Analysis window [start, end), 0 < minutes <= max, 0 < miles <= max, 0 < fare <= max."""
    b = dict(TRIP_BOUNDS, **(bounds or {}))
    start = F.lit(b["window_start"]).cast("timestamp_ntz")
    end = F.lit(b["window_end"]).cast("timestamp_ntz")
    return ((F.col("pickup_datetime") >= start) & (F.col("pickup_datetime") < end)
            & (F.col("trip_duration_minutes") > 0) & (F.col("trip_duration_minutes") <= b["max_minutes"])
            & (F.col("trip_distance_miles") > 0) & (F.col("trip_distance_miles") <= b["max_miles"])
            & (F.col("fare_amount") > 0) & (F.col("fare_amount") <= b["max_fare"])
            & F.col("pickup_location_id").isNotNull() & F.col("dropoff_location_id").isNotNull())


def stage_trips(raw: DataFrame, bounds: dict | None = None) -> DataFrame:
    """stg trips = filter(standardise(dedupe(raw))).

    The window, duration and zone predicates only read identity columns, so
    Catalyst pushes them below the dedupe window into the Parquet scan; the
    fare and distance bounds stay above it (rows equal in hundredths may sit
    on both sides of a bound).
    """
    return standardise_trips(dedupe_trips(raw)).where(valid_trip(bounds))


def stage_weather(raw: DataFrame) -> DataFrame:
    """Parse the hour, convert units, classify severity, add flags."""
    hour_col = raw.schema["datetime_hour"].dataType
    if isinstance(hour_col, (T.TimestampType, T.TimestampNTZType)):
        ts = F.col("datetime_hour").cast("timestamp_ntz")
    else:
        ts = cal.parse_iso_minute("datetime_hour")
    temp, rain, snow = (F.col("temperature_2m").cast("double"), F.col("precipitation").cast("double"),
                        F.col("snowfall").cast("double"))
    return raw.select(
        ts.alias("weather_datetime"),
        F.to_date(ts).alias("weather_date"),
        F.hour(ts).cast("bigint").alias("weather_hour"),
        temp.alias("temperature_celsius"),
        celsius_to_fahrenheit(temp).alias("temperature_fahrenheit"),
        rain.alias("precipitation_mm"),
        snow.alias("snowfall_cm"),
        F.col("windspeed_10m").cast("double").alias("windspeed_kmh"),
        F.col("visibility").cast("double").alias("visibility_metres"),
        F.col("weathercode").cast("bigint").alias("weather_code"),
        weather_severity(snow, rain, temp).alias("weather_severity"),
        (snow > 0).alias("has_snowfall"),
        (rain > 0).alias("has_precipitation"),
        (temp < 0).alias("is_below_freezing"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("timezone"),
    )


def stage_alerts(raw: DataFrame, alert_tz: str | None = None) -> DataFrame:
    """Keep alerts with both times, epoch text -> UTC timestamps, score the effect."""
    kept = raw.where(F.col("start_time").isNotNull() & F.col("end_time").isNotNull()
                     & (F.col("start_time") != "") & (F.col("end_time") != ""))
    start = cal.from_epoch_seconds(F.expr("try_cast(start_time as bigint)"))
    end = cal.from_epoch_seconds(F.expr("try_cast(end_time as bigint)"))
    if alert_tz:  # trips and weather are on the local clock, epochs are not; the default follows the source and stays UTC
        start, end = (F.convert_timezone(F.lit("UTC"), F.lit(alert_tz), t) for t in (start, end))
    return kept.select(
        "alert_id",
        "subway_line",
        start.alias("alert_start_datetime"),
        end.alias("alert_end_datetime"),
        cal.minutes_between(start, end).alias("alert_duration_minutes"),
        "cause",
        "effect",
        disruption_score("effect").alias("disruption_severity_score"),
        F.col("is_synthetic").cast("boolean").alias("is_synthetic"),
        "ingested_at",
        F.to_date(start).alias("alert_date"),
    )
