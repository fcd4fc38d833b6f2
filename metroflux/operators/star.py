"""Marts: location, time and weather dimensions and the trip fact table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.functions import calendar as cal
from metroflux.functions import classify as cl
from metroflux.functions.keys import surrogate_key
from metroflux.operators.dedupe import dedupe, total_order
from metroflux.operators.joins import bounded_broadcast

TRIP_KEY = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
            "vendor_id", "fare_amount", "trip_distance_miles", "passenger_count"]


def dim_location(zones: DataFrame) -> DataFrame:
    """Zone dimension with borough rank and demand category."""
    return zones.select(
        F.col("LocationID").cast("bigint").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
        cl.borough_rank("Borough").alias("borough_rank"),
        cl.demand_category("service_zone").alias("demand_category"),
    )


def date_spine(spark: SparkSession, start: str, end: str, step: str = "hour") -> DataFrame:
    """One row per `step` from `start` (inclusive) to `end` (exclusive).

    Generated with `range` so the rows are spread over tasks instead of being
    exploded from one array in one task.
    """
    unit = {"hour": 3600, "day": 86400}[step]
    t0, t1 = datetime.fromisoformat(start), datetime.fromisoformat(end)
    n = max(0, int((t1 - t0).total_seconds() // unit))
    return (spark.range(n).select(
        F.timestamp_add("SECOND", F.col("id") * unit,
                        F.lit(t0.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")).alias("date_hour")))


def spine_rows(start: str, end: str, step: str = "hour") -> int:
    unit = {"hour": 3600, "day": 86400}[step]
    return max(0, int((datetime.fromisoformat(end) - datetime.fromisoformat(start)).total_seconds() // unit))


def spine_of(df: DataFrame, ts: str) -> DataFrame:
    """E02 from data: every hour of the months from the first to the last time in `df` (no row for an empty table)."""
    t = F.col(ts).cast("timestamp_ntz")
    first, last = (F.trunc(F.to_date(x(t)), "MM") for x in (F.min, F.max))
    bounds = df.agg(first.alias("a"), F.add_months(last, 1).alias("b")).where(F.col("a").isNotNull())
    hour = F.expr("interval 1 hour")
    return bounds.select(F.explode(F.sequence(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz") - hour, hour))
                         .alias("date_hour"))


def dim_time(spine: DataFrame) -> DataFrame:
    """Calendar attributes, five-label time of day, analysis month, holiday flag."""
    h = F.col("date_hour")
    return spine.select(
        h.alias("datetime_hour"),
        F.to_date(h).alias("date_day"),
        F.year(h).cast("bigint").alias("year"),
        F.month(h).cast("bigint").alias("month"),
        F.dayofmonth(h).cast("bigint").alias("day"),
        F.hour(h).cast("bigint").alias("hour"),
        cal.day_of_week(h).alias("day_of_week"),
        F.date_format(h, "EEEE").alias("day_name"),
        F.date_format(h, "MMMM").alias("month_name"),
        F.when(cal.is_weekend(h), True).otherwise(False).alias("is_weekend"),
        cal.dim_time_of_day(F.hour(h)).alias("time_of_day"),
        cal.analysis_month(F.month(h)).alias("analysis_month"),
        cal.is_holiday_period(F.month(h), F.dayofmonth(h)).alias("is_holiday_period"),
    )


def dim_weather(weather: DataFrame) -> DataFrame:
    """Staged weather with impact score and precipitation type."""
    return weather.select(
        "weather_datetime", "weather_date", "weather_hour", "temperature_celsius",
        "temperature_fahrenheit", "precipitation_mm", "snowfall_cm", "windspeed_kmh",
        "visibility_metres", "weather_severity", "has_snowfall", "has_precipitation",
        "is_below_freezing",
        cl.weather_impact_score().alias("weather_impact_score"),
        cl.precipitation_type().alias("precipitation_type"),
    )


FACT_COLUMNS = [
    "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour",
    "pickup_day_of_week", "is_weekend", "time_of_day", "is_holiday_period", "analysis_month",
    "pickup_location_id", "dropoff_location_id", "pickup_borough", "pickup_zone",
    "pickup_demand_category", "dropoff_borough", "dropoff_zone", "passenger_count",
    "trip_distance_miles", "trip_duration_minutes", "trip_duration_bucket", "trip_distance_bucket",
    "avg_speed_mph", "rate_code_id", "payment_type", "fare_amount", "tip_amount", "tolls_amount",
    "total_amount", "tip_percentage", "congestion_surcharge", "airport_fee", "mta_tax",
    "temperature_celsius", "precipitation_mm", "snowfall_cm", "weather_severity", "is_snow_trip",
    "is_rain_trip", "is_below_freezing", "has_subway_disruption", "subway_lines_affected",
    "max_disruption_severity", "is_compound_disruption", "has_synthetic_mta_data", "vendor_id",
]


def fact_trips(metrics: DataFrame, disruptions: DataFrame, locations: DataFrame, time_dim: DataFrame,
               time_rows: int | None = None, final_dedupe: bool = True,
               disruption_rows: int | None = None) -> DataFrame:
    """One row per trip with zone, time, weather and disruption context.

    The disruption columns of a trip are those of its zone-hour impact row,
    and that row only carries the city-wide disruption of the date-hour plus
    the hour's weather severity, which the trip already has. So the trip
    joins the hourly disruption table (at most 24 rows per alert day) instead
    of the zone-hour impact table, and no roll-up has to run. The hourly sides are
    broadcast by the bound that the window gives (`time_rows`, `disruption_rows`), the
    zone registry by the planner's byte check, so the trips stream through without a shuffle.

    E13 keeps one row per trip_id (first by pickup time, then all columns).
    trip_id is a function of the staging dedupe key, so the fact can only
    hold a duplicate when a join fans out; with dimensions asserted unique
    (`final_dedupe=False`, see Pipeline.assert_unique) that cannot happen and the
    shuffle of the widest table is skipped.
    """
    t = metrics.withColumn("trip_id", surrogate_key(metrics, TRIP_KEY)).alias("trips")
    h = bounded_broadcast(disruptions.select("alert_date", "hour_of_day", "severe_alert_count",
                                             "lines_affected", "max_severity_score", "has_synthetic_data"),
                          disruption_rows).alias("h")
    loc = locations.select("location_id", "borough", "zone_name", "demand_category")
    pl, dl = loc.alias("pl"), loc.alias("dl")
    td = bounded_broadcast(time_dim.select("datetime_hour", "time_of_day", "is_holiday_period",
                                           "analysis_month"), time_rows).alias("t")
    j = (t.join(h, (F.col("trips.pickup_date") == F.col("h.alert_date"))
                & (F.col("trips.pickup_hour") == F.col("h.hour_of_day")), "left")
          .join(pl, F.col("trips.pickup_location_id") == F.col("pl.location_id"), "left")
          .join(dl, F.col("trips.dropoff_location_id") == F.col("dl.location_id"), "left")
          .join(td, cal.truncate_hour(F.col("trips.pickup_datetime")) == F.col("t.datetime_hour"), "left"))
    tc = lambda c: F.col(f"trips.{c}").alias(c)
    severe = F.col("h.severe_alert_count")
    joined = j.select(
        tc("trip_id"), tc("pickup_datetime"), tc("dropoff_datetime"), tc("pickup_date"),
        tc("pickup_hour"), tc("pickup_day_of_week"), tc("is_weekend"),
        F.col("t.time_of_day").alias("time_of_day"),
        F.col("t.is_holiday_period").alias("is_holiday_period"),
        F.col("t.analysis_month").alias("analysis_month"),
        tc("pickup_location_id"), tc("dropoff_location_id"),
        F.col("pl.borough").alias("pickup_borough"), F.col("pl.zone_name").alias("pickup_zone"),
        F.col("pl.demand_category").alias("pickup_demand_category"),
        F.col("dl.borough").alias("dropoff_borough"), F.col("dl.zone_name").alias("dropoff_zone"),
        tc("passenger_count"), tc("trip_distance_miles"), tc("trip_duration_minutes"),
        tc("trip_duration_bucket"), tc("trip_distance_bucket"), tc("avg_speed_mph"),
        tc("rate_code_id"), tc("payment_type"), tc("fare_amount"), tc("tip_amount"),
        tc("tolls_amount"), tc("total_amount"), tc("tip_percentage"), tc("congestion_surcharge"),
        tc("airport_fee"), tc("mta_tax"), tc("temperature_celsius"), tc("precipitation_mm"),
        tc("snowfall_cm"), tc("weather_severity"), tc("is_snow_trip"), tc("is_rain_trip"),
        tc("is_below_freezing"),
        F.when(severe > 0, True).otherwise(False).alias("has_subway_disruption"),
        F.coalesce(F.col("h.lines_affected"), F.lit(0)).cast("bigint").alias("subway_lines_affected"),
        F.coalesce(F.col("h.max_severity_score"), F.lit(0)).cast("bigint").alias("max_disruption_severity"),
        cl.is_compound(severe, F.col("trips.weather_severity")).alias("is_compound_disruption"),
        F.coalesce(F.col("h.has_synthetic_data"), F.lit(False)).alias("has_synthetic_mta_data"),
        tc("vendor_id"),
    )
    if not final_dedupe:
        return joined.select(*FACT_COLUMNS)
    order = total_order(joined, first=["pickup_datetime"], exclude=["trip_id"])
    return dedupe(joined, ["trip_id"], order).select(*FACT_COLUMNS)


# ---------------------------------------------------------------------------
# the same star building on a second shape (orders, customers, nations)
# ---------------------------------------------------------------------------

def dim_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Nation dimension with its region (nation left join region)."""
    r = region.select("r_regionkey", "r_name")
    return nation.join(r, nation.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("bigint").alias("nation_key"), F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"))


def orders_star(orders: DataFrame, customer: DataFrame, nations: DataFrame) -> DataFrame:
    """Orders with calendar attributes, customer and the customer's nation and region.

    Customers and nations are left to the planner, which broadcasts a side only
    when its bytes are under the session's threshold.
    """
    o = orders.alias("o")
    c = customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey").alias("c")
    n = nations.alias("n")
    j = (o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"), "left")
          .join(n, F.col("c.c_nationkey") == F.col("n.nation_key"), "left"))
    od = F.col("o.o_orderdate").cast("timestamp_ntz")
    keyed = j.select(
        F.col("o.o_orderkey").alias("o_orderkey"), od.alias("o_orderdate"),
        F.year(od).cast("bigint").alias("order_year"), F.month(od).cast("bigint").alias("order_month"),
        cal.day_of_week(od).alias("order_day_of_week"),
        F.when(cal.is_weekend(od), True).otherwise(False).alias("is_weekend"),
        F.col("o.o_orderstatus").alias("o_orderstatus"), F.col("o.o_orderpriority").alias("o_orderpriority"),
        F.col("o.o_totalprice").alias("o_totalprice"),
        F.col("c.c_name").alias("customer_name"), F.col("c.c_mktsegment").alias("customer_segment"),
        F.col("n.nation_name").alias("customer_nation"), F.col("n.region_name").alias("customer_region"),
        F.col("o.o_custkey").alias("o_custkey"))
    return keyed.withColumn("order_id", surrogate_key(keyed, ["o_orderkey", "o_orderdate", "o_custkey"]))
