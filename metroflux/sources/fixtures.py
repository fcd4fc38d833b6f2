"""Adapters that shape the supplied test tables into the raw feeds.

The test data has no taxi, weather or alert tables; these deterministic
projections of `events` and `nation` produce the raw shapes (see FIXTURES.md).
They are plain column expressions, so their cost grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.functions.calendar import epoch_seconds, truncate_hour

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_raw(events: DataFrame, odd: bool = False) -> DataFrame:
    """One trip per event, a second copy of every 49th, and of some a trip a month later, a month earlier, or long ago.

    A third of all trips starts in one zone, most others in four, some in zones that the registry lacks. Miles have two,
    three or five decimals. With `odd` further rows come in, some without a pickup time and some over 100 miles long.
    """
    i = F.col("event_id")
    e = events.select("event_id", "ts", "value")
    days = F.when(i % 97 == 1, 31).when(i % 97 == 2, -31).when(i % 97 == 3, -8000).otherwise(0)
    more = e.where((i % 49 == 0) | (i % 97).between(1, 3)).withColumn("ts", F.timestamp_add("DAY", days, F.col("ts")))
    e = e.unionByName(more)
    when, long = F.col("ts"), F.lit(False)
    if odd:
        rows = events.select("event_id", "ts", "value")
        e = e.withColumn("odd", F.lit("")).unionByName(rows.where(i % 211 == 5).withColumn("odd", F.lit("undated"))).unionByName(
            rows.where(i % 499 == 7).withColumn("odd", F.lit("long")))
        when, long = F.when(F.col("odd") != "undated", F.col("ts")), F.col("odd") == "long"
    pickup = F.when(i % 3 == 0, 132).when(i % 40 == 1, 251 + i % 15).otherwise(1 + i * 13 % 4)
    tip = (i * 7 % 1500).cast("double") / 100
    return e.select(
        (1 + i % 2).cast("bigint").alias("VendorID"),
        when.alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", i * 37 % 7200 - 600, F.col("ts")).alias("tpep_dropoff_datetime"),
        F.when(i % 89 == 0, F.lit(None)).otherwise(1 + i % 6).cast("bigint").alias("passenger_count"),
        F.when(long, (101 + i % 50).cast("double")).otherwise(
            (i * 31 % 4500).cast("double") / 100 + F.when(i % 7 == 0, (i % 997).cast("double") / 100000)
            .when(i % 7 == 1, (i % 9).cast("double") / 1000).otherwise(0.0)).alias("trip_distance"),
        (1 + i % 4).cast("bigint").alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        pickup.cast("bigint").alias("PULocationID"),
        (1 + i * 29 % 265).cast("bigint").alias("DOLocationID"),
        (1 + i % 4).cast("bigint").alias("payment_type"),
        F.col("value").alias("fare_amount"),
        ((i % 5).cast("double") / 2).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        tip.alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("Airport_fee"),
        F.lit(0.75).alias("cbd_congestion_fee"),
        (F.col("value") + tip - F.when(i % 41 == 0, 20).otherwise(0)).alias("total_amount"),
    )


def weather_raw(events: DataFrame, odd: bool = False) -> DataFrame:
    """One weather row for every hour that has at least one event, but for a few hours that the feed lacks. With `odd` it has some twice."""
    hours = events.select(truncate_hour("ts").alias("h")).distinct().where(
        (F.dayofmonth("h") % 11 != 5) | (F.hour("h") != 3))
    if odd:
        hours = hours.unionByName(hours.where((F.dayofmonth("h") == 13) & (F.hour("h") == 7)))
    d, hr = F.dayofmonth("h"), F.hour("h")
    return hours.select(
        F.date_format("h", "yyyy-MM-dd'T'HH:mm").alias("datetime_hour"),
        ((d * 7 + hr * 3) % 50 - 12).cast("double").alias("temperature_2m"),
        (((d * 5 + hr) % 9).cast("double") * 0.8).alias("precipitation"),
        F.when(d % 6 == 0, (hr % 5).cast("double") * 0.7).otherwise(0.0).alias("snowfall"),
        (hr % 30).cast("double").alias("windspeed_10m"),
        (d % 4).cast("bigint").alias("weathercode"),
        F.lit(10000.0).alias("visibility"),
        F.lit(40.7).alias("latitude"),
        F.lit(-74.0).alias("longitude"),
        F.lit("UTC").alias("timezone"),
    )


def alerts_raw(events: DataFrame) -> DataFrame:
    """Alerts from the error events: start on the hour, 1-9 h long, some blank ends."""
    i = F.col("event_id")
    start = epoch_seconds(truncate_hour("ts"))
    return events.where(F.col("event_type") == "error").select(
        F.concat(F.lit("a"), i.cast("string")).alias("alert_id"),
        F.concat(F.lit("L"), (F.col("user_id") % 23).cast("string")).alias("subway_line"),
        F.when(i % 5 == 0, "MAINTENANCE").when(i % 5 == 1, "ACCIDENT")
         .otherwise("UNKNOWN_CAUSE").alias("cause"),
        F.when(i % 6 == 0, "NO_SERVICE").when(i % 6 == 1, "SIGNIFICANT_DELAYS")
         .when(i % 6 == 2, "REDUCED_SERVICE").when(i % 6 == 3, "MODIFIED_SERVICE")
         .when(i % 6 == 4, "DETOUR").otherwise("OTHER_EFFECT").alias("effect"),
        F.col("props").alias("header_text"),
        start.cast("string").alias("start_time"),
        F.when(i % 83 == 0, F.lit("")).otherwise((start + 3600 * (1 + i % 9)).cast("string"))
         .alias("end_time"),
        F.lit(None).cast("string").alias("ingested_at"),
        F.when(i % 3 == 0, F.lit(None).cast("boolean")).otherwise(i % 3 == 1).alias("is_synthetic"),
    )


def zones(nation: DataFrame) -> DataFrame:
    """Ten zones per nation: 250 zone rows with every borough rule reached, some in a borough that is not accepted."""
    k = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")
    n = nation.select("n_nationkey", "n_name", "n_regionkey", k)
    rk, nk = F.col("n_regionkey"), F.col("n_nationkey")
    return n.select(
        (1 + nk + 25 * F.col("k")).cast("bigint").alias("LocationID"),
        F.when((F.col("k") == 9) & (nk % 5 == 0), "Harbour").when(rk == 0, "Manhattan").when(rk == 1, "Queens").when(rk == 2, "Brooklyn")
         .when(rk == 3, "Bronx").otherwise("N/A").alias("Borough"),
        F.concat(F.col("n_name"), F.lit("/"), F.col("k").cast("string")).alias("Zone"),
        F.when(nk % 5 == 0, "Yellow Zone").when(nk % 5 == 1, "Boro Zone")
         .when(nk % 5 == 2, "Airports").when(nk % 5 == 3, "N/A")
         .otherwise("Elsewhere").alias("service_zone"),
    )


class Feeds:
    """The four raw feeds of one test-data directory, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, odd: bool = False):
        self.spark, self.sf_dir, self.odd = spark, sf_dir, odd

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def trips_raw(self) -> DataFrame:
        return trips_raw(self.table("events"), self.odd)

    def weather_raw(self) -> DataFrame:
        return weather_raw(self.table("events"), self.odd)

    def alerts_raw(self) -> DataFrame:
        return alerts_raw(self.table("events"))

    def zones(self) -> DataFrame:
        return zones(self.table("nation"))


# ---------------------------------------------------------------------------
# JSON feed documents derived from the test tables
# ---------------------------------------------------------------------------

def weather_json_docs(events: DataFrame, odd: bool = False) -> DataFrame:
    """One columnar weather document per month of hours (at most 744 hours per document), and per month one without hours."""
    from metroflux.sources.json_feeds import WEATHER_MEASURES
    w = weather_raw(events, odd)
    month = F.substring("datetime_hour", 1, 7)
    g = w.groupBy(month.alias("m"), "latitude", "longitude", "timezone").agg(
        F.sort_array(F.collect_list(F.struct("datetime_hour", *WEATHER_MEASURES))).alias("h"))
    hourly = F.struct(F.col("h.datetime_hour").alias("time"), *[F.col(f"h.{c}").alias(c) for c in WEATHER_MEASURES])
    texts = F.array(F.to_json(F.struct("latitude", "longitude", "timezone", hourly.alias("hourly"))),
                    F.to_json(F.struct("latitude", F.col("m").alias("reason"))))
    return g.select(F.explode(texts).alias("value"))


def alert_json_docs(events: DataFrame) -> DataFrame:
    """One service-alert entity per error event, covering the feed's edge cases:
    unknown routes, alerts with no known line, two lines, a missing or empty period
    list, a missing cause, long headers, and malformed text."""
    from metroflux.schemas import SUBWAY_LINES
    i, u = F.col("event_id"), F.col("user_id")
    lines = F.array(*[F.lit(x) for x in SUBWAY_LINES])
    known = F.struct(F.element_at(lines, (u % 23 + 1).cast("int")).alias("route_id"))
    second = F.struct(F.element_at(lines, ((u + 7) % 23 + 1).cast("int")).alias("route_id"))
    unknown = F.struct(F.concat(F.lit("BX"), (u % 5).cast("string")).alias("route_id"))
    routes = (F.when(i % 5 == 0, F.array(unknown))
              .when(i % 4 == 0, F.array(known, unknown, second))
              .otherwise(F.array(unknown, known)))
    start = epoch_seconds(truncate_hour("ts"))
    period = F.struct(start.cast("string").alias("start"),
                      (start + 3600 * (1 + i % 9)).cast("string").alias("end"))
    periods = (F.when(i % 83 == 0, F.array().cast("array<struct<start:string,end:string>>"))
               .when(i % 97 == 0, F.lit(None).cast("array<struct<start:string,end:string>>"))
               .otherwise(F.array(period)))
    header = F.struct(F.array(F.struct(F.repeat(F.col("props"), (1 + i % 60).cast("int")).alias("text")))
                      .alias("translation"))
    cause = F.when(i % 11 == 0, F.lit(None)).when(i % 5 == 1, "ACCIDENT").otherwise("MAINTENANCE")
    effect = (F.when(i % 6 == 0, "NO_SERVICE").when(i % 6 == 1, "SIGNIFICANT_DELAYS")
              .when(i % 6 == 2, "REDUCED_SERVICE").otherwise("DETOUR"))
    entity = F.struct(F.concat(F.lit("a"), i.cast("string")).alias("id"),
                      F.struct(routes.alias("informed_entity"), periods.alias("active_period"),
                               header.alias("header_text"), cause.alias("cause"),
                               effect.alias("effect")).alias("alert"))
    text = F.to_json(entity)
    text = F.when(i % 101 == 0, F.substring(text, 1, 25)).otherwise(text)
    return events.where(F.col("event_type") == "error").select(text.alias("value"))
