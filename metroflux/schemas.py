"""Raw-table contracts and the fixed values the pipeline must reproduce."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw table contracts (one StructType per landed source)
# ---------------------------------------------------------------------------

TRIPS_RAW = T.StructType([
    T.StructField("VendorID", T.LongType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.LongType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.LongType()),
    T.StructField("DOLocationID", T.LongType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("Airport_fee", T.DoubleType()),
    T.StructField("cbd_congestion_fee", T.DoubleType()),
])

# columns a trips batch must carry, else the load fails
TRIPS_REQUIRED = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
    "DOLocationID", "fare_amount", "trip_distance",
]

WEATHER_RAW = T.StructType([
    T.StructField("datetime_hour", T.StringType()),
    T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("snowfall", T.DoubleType()),
    T.StructField("windspeed_10m", T.DoubleType()),
    T.StructField("weathercode", T.LongType()),
    T.StructField("visibility", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
])

ALERTS_RAW = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField("subway_line", T.StringType()),
    T.StructField("cause", T.StringType()),
    T.StructField("effect", T.StringType()),
    T.StructField("header_text", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("is_synthetic", T.BooleanType()),
])

ZONES = T.StructType([
    T.StructField("LocationID", T.LongType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

# Hourly weather feed as delivered: parallel arrays under `hourly`.
WEATHER_JSON = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("snowfall", T.ArrayType(T.DoubleType())),
        T.StructField("windspeed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("weathercode", T.ArrayType(T.LongType())),
        T.StructField("visibility", T.ArrayType(T.DoubleType())),
    ])),
])

# One alert entity of the service-alert feed.
ALERT_ENTITY_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("alert", T.StructType([
        T.StructField("informed_entity", T.ArrayType(T.StructType([
            T.StructField("route_id", T.StringType()),
        ]))),
        T.StructField("active_period", T.ArrayType(T.StructType([
            T.StructField("start", T.StringType()),
            T.StructField("end", T.StringType()),
        ]))),
        T.StructField("header_text", T.StructType([
            T.StructField("translation", T.ArrayType(T.StructType([
                T.StructField("text", T.StringType()),
            ]))),
        ])),
        T.StructField("cause", T.StringType()),
        T.StructField("effect", T.StringType()),
    ])),
])

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------

# subway lines accepted from the alert feed
SUBWAY_LINES = [
    "1", "2", "3", "4", "5", "6", "7",
    "A", "C", "E", "B", "D", "F", "M",
    "G", "J", "Z", "L", "N", "Q", "R", "W",
    "S",
]
HEADER_MAX_CHARS = 500
DEFAULT_CAUSE = "UNKNOWN_CAUSE"
DEFAULT_EFFECT = "UNKNOWN_EFFECT"

# alert effect -> disruption severity score (anything else scores 0)
EFFECT_SCORES = [
    ("NO_SERVICE", 5),
    ("SIGNIFICANT_DELAYS", 4),
    ("REDUCED_SERVICE", 3),
    ("MODIFIED_SERVICE", 2),
    ("DETOUR", 1),
]
SEVERE_SCORE = 4
MODERATE_SCORE = 2

# weather severity labels
WEATHER_SEVERITIES = [
    "clear", "light_rain", "heavy_rain", "light_snow", "heavy_snow",
    "extreme_cold", "extreme_heat", "warm",
]
SNOW_SEVERITIES = ["heavy_snow", "light_snow"]
RAIN_SEVERITIES = ["heavy_rain", "light_rain"]
COMPOUND_SEVERITIES = ["heavy_snow", "light_snow", "heavy_rain"]

# borough -> rank (anything else 99)
BOROUGH_RANKS = [
    ("Manhattan", 1), ("Queens", 2), ("Brooklyn", 3), ("Bronx", 4),
    ("Staten Island", 5), ("EWR", 6), ("Unknown", 7), ("N/A", 8),
]
# service zone -> demand category (anything else 'other')
DEMAND_CATEGORIES = [
    ("Yellow Zone", "high_demand"), ("Boro Zone", "medium_demand"),
    ("Airports", "airport"), ("EWR", "airport"), ("N/A", "unassigned"),
]

# weather rules in order of precedence: measure, comparison, limit, severity, impact score
WEATHER_RULES = [
    ("snow", ">", 2.0, "heavy_snow", 5),
    ("snow", ">", 0.5, "light_snow", 4),
    ("rain", ">", 5.0, "heavy_rain", 3),
    ("rain", ">", 1.0, "light_rain", 2),
    ("temp", "<", -5, "extreme_cold", 2),
    ("temp", ">", 30, "extreme_heat", 1),
    ("temp", ">", 22, "warm", 1),
]

DURATION_EDGES = [10, 30, 60]
DISTANCE_EDGES = [1, 6, 21, 51, 100]
DURATION_BUCKETS = ["short", "medium", "long", "very_long"]
DISTANCE_BUCKETS = ["under_1_mile", "1_to_5_miles", "6_to_20_miles",
                    "21_to_50_miles", "51_to_100_miles", "over_100_miles"]
TRIP_TIME_OF_DAY = ["early_morning", "late_morning", "afternoon_peak",
                    "evening_peak", "late_night", "mid_night", "off_peak"]
DIM_TIME_OF_DAY = ["morning_peak", "evening_peak", "late_night", "mid_night", "off_peak"]
BOROUGHS = ["Manhattan", "Queens", "Brooklyn", "Bronx", "Staten Island", "EWR", "Unknown", "N/A"]
DEMAND_CATEGORY_VALUES = ["high_demand", "medium_demand", "airport", "unassigned", "other"]
PRECIPITATION_TYPES = ["snow_and_rain", "snow_only", "rain_only", "dry"]

# trip validity bounds of the staging filter
TRIP_BOUNDS = {
    "window_start": "2025-11-01 00:00:00",
    "window_end": "2026-02-01 00:00:00",   # exclusive
    "max_minutes": 90,
    "max_miles": 40.0,
    "max_fare": 150.0,
}
# the same bounds for the supplied test tables (their trips fall in January 2024)
FIXTURE_BOUNDS = dict(TRIP_BOUNDS, window_start="2024-01-01 00:00:00",
                      window_end="2024-02-01 00:00:00")

# analysis months (month number -> name) and the holiday window
ANALYSIS_MONTHS = [(11, "November"), (12, "December"), (1, "January")]
HOLIDAY_RANGES = [(12, 20, 31), (1, 1, 3)]   # (month, first day, last day)

# source freshness policy, in days
FRESHNESS_WARN_DAYS = 7
FRESHNESS_ERROR_DAYS = 30

# fare histogram edges used in the published fare distribution
FARE_BAND_EDGES = [50.0, 100.0, 150.0]

# surrogate key text form
KEY_SEPARATOR = "-"
KEY_NULL = "_null_"
