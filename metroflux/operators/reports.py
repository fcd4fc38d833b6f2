"""Report queries over the trip fact and the zone-hour impact table.

Each report is one aggregation (partial + final hash aggregate); no report
collects rows to the driver. Sums and averages are those of raw doubles, exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.functions.classify import fare_band
from metroflux.functions.numeric import difference, exact_mean, exact_sum, mean_rounded, mean_rounded_int, share_pct
from metroflux.schemas import FARE_BAND_EDGES, TRIP_BOUNDS

FLAG = "has_subway_disruption"


def kpi_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_trips"),
        exact_sum("total_amount").alias("total_revenue"),
        mean_rounded("fare_amount", 2).alias("avg_fare"),
        mean_rounded("avg_speed_mph", 1).alias("avg_speed_mph"),
        mean_rounded_int("trip_duration_minutes", 2).alias("avg_duration_minutes"),
        F.count_if(F.col(FLAG)).alias("disruption_trips"),
    ]


def kpi(fact: DataFrame) -> DataFrame:
    """Headline row: trips, revenue, average fare, speed, duration, disruption trips."""
    return fact.agg(*kpi_measures())


def hourly_by_disruption(fact: DataFrame) -> DataFrame:
    """Per pickup hour and disruption status: trips, average fare and speed."""
    return fact.groupBy("pickup_hour", FLAG).agg(
        F.count(F.lit(1)).alias("trips"),
        mean_rounded("fare_amount", 2).alias("avg_fare"),
        mean_rounded("avg_speed_mph", 1).alias("avg_speed_mph"))


def fare_by_tod(fact: DataFrame) -> DataFrame:
    """Per time of day and disruption status: average fare, tip and tip %."""
    return fact.groupBy("time_of_day", FLAG).agg(
        mean_rounded("fare_amount", 2).alias("avg_fare"),
        mean_rounded("tip_amount", 2).alias("avg_tip"),
        mean_rounded("tip_percentage", 1).alias("avg_tip_percentage"))


def trips_by_tod(fact: DataFrame) -> DataFrame:
    """Per time of day and disruption status: trips, average fare and speed."""
    return fact.groupBy("time_of_day", FLAG).agg(
        F.count(F.lit(1)).alias("trips"),
        mean_rounded("fare_amount", 2).alias("avg_fare"),
        mean_rounded("avg_speed_mph", 1).alias("avg_speed_mph"),
        mean_rounded_int("trip_duration_minutes", 1).alias("avg_duration_minutes"))


def monthly_volume(fact: DataFrame) -> DataFrame:
    """Per pickup month and disruption status: trips, revenue, average fare."""
    return fact.groupBy(F.trunc("pickup_date", "month").alias("month_start"), "analysis_month", FLAG).agg(
        F.count(F.lit(1)).alias("trips"),
        exact_sum("total_amount").alias("revenue"),
        mean_rounded("fare_amount", 2).alias("avg_fare"))


def slice_by(df: DataFrame, month: str | None = None, disrupted: bool | None = None,
             severities: list[str] | None = None) -> DataFrame:
    """The dashboard slicers (month name, disruption status, weather severity)."""
    if month is not None:
        df = df.where(F.col("analysis_month") == month)
    if disrupted is not None:
        df = df.where(F.col(FLAG) == F.lit(disrupted))
    if severities:
        df = df.where(F.col("weather_severity").isin(*severities))
    return df


def fare_bands(trips: DataFrame, edges=tuple(FARE_BAND_EDGES)) -> DataFrame:
    """Trips per fare band with the band's share of all trips (percent, 2 decimals)."""
    g = trips.groupBy(fare_band("fare_amount", edges).alias("fare_band")).agg(F.count(F.lit(1)).alias("trips"))
    # the window runs over the handful of band rows only, after the aggregation
    total = F.sum("trips").over(Window.partitionBy())
    return g.select("fare_band", "trips", share_pct(F.col("trips"), total).alias("pct_of_total"))


def outlier_counts(trips: DataFrame, bounds: dict | None = None) -> DataFrame:
    """Rows breaking each outlier rule and rows breaking any (staged columns, before filtering)."""
    b = dict(TRIP_BOUNDS, **(bounds or {}))
    rules = {
        "over_max_minutes": F.col("trip_duration_minutes") > b["max_minutes"],
        "non_positive_minutes": F.col("trip_duration_minutes") <= 0,
        "over_max_miles": F.col("trip_distance_miles") > b["max_miles"],
        "non_positive_miles": F.col("trip_distance_miles") <= 0,
        "over_max_fare": F.col("fare_amount") > b["max_fare"],
        "non_positive_fare": F.col("fare_amount") <= 0,
    }
    anyrule = None
    for r in rules.values():
        anyrule = r if anyrule is None else (anyrule | r)
    return trips.agg(F.count(F.lit(1)).alias("rows_checked"),
                     *[F.count_if(r).alias(n) for n, r in rules.items()],
                     F.count_if(anyrule).alias("any_rule"))


def negative_adjustments(fact: DataFrame) -> DataFrame:
    """Trips whose total is below the fare: count, average gap, smallest total."""
    neg = fact.where(F.col("total_amount") < F.col("fare_amount"))
    return neg.agg(
        F.count(F.lit(1)).alias("trips"),
        mean_rounded(F.col("fare_amount") - F.col("total_amount"), 2).alias("avg_gap"),
        F.min("total_amount").alias("min_total_amount"))


def duplicate_profile(raw: DataFrame, keys: list, by: str = "VendorID") -> DataFrame:
    """Per `by`: duplicated identities and surplus rows (copies beyond the first)."""
    g = raw.groupBy(F.col(by).alias(by), *keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    return g.groupBy(by).agg(F.count(F.lit(1)).alias("duplicate_groups"),
                             F.sum(F.col("copies") - 1).cast("bigint").alias("surplus_rows"))


def out_of_window(raw: DataFrame, start: str, end: str, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Raw rows by position against the window: far outside (clock errors), the month
    just before or after (month overflow), or inside."""
    t = F.col(ts)
    s, e = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    kind = (F.when(t.isNull(), "missing")
            .when((t < F.add_months(s, -1)) | (t >= F.add_months(e, 1)), "old_clock")
            .when(t < s, "month_overflow_before")
            .when(t >= e, "month_overflow_after")
            .otherwise("in_window"))
    return raw.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("trips"))


def reduction_ratio(trips: DataFrame, demand: DataFrame) -> DataFrame:
    """How many fewer rows the zone-hour roll-up has than the trips (percent)."""
    tagged = (trips.select(F.lit(True).alias("is_trip"))
              .unionByName(demand.select(F.lit(False).alias("is_trip"))))
    c = tagged.agg(F.count_if(F.col("is_trip")).alias("trip_rows"),
                   F.count_if(~F.col("is_trip")).alias("zone_hour_rows"))
    return c.select("trip_rows", "zone_hour_rows",
                    share_pct(F.col("trip_rows") - F.col("zone_hour_rows"), F.col("trip_rows"))
                    .alias("reduction_pct"))


def holiday_split(fact: DataFrame) -> DataFrame:
    """Holiday window against the rest: trips, revenue, average fare."""
    return fact.groupBy("is_holiday_period").agg(
        F.count(F.lit(1)).alias("trips"),
        exact_sum("total_amount").alias("revenue"),
        mean_rounded("fare_amount", 2).alias("avg_fare"))


def disruption_gap(fact: DataFrame) -> DataFrame:
    """Per time of day, disrupted minus normal average fare, speed and minutes."""
    d, n = F.col(FLAG), ~F.col(FLAG)
    out = []
    for c, name, places in [("fare_amount", "fare", 2), ("avg_speed_mph", "speed_mph", 2),
                            ("trip_duration_minutes", "duration_minutes", 2)]:
        of = lambda rows: F.round(exact_mean(F.when(rows, F.col(c))), places)  # noqa: E731, B023
        out.append(difference(of(d), of(n), places).alias(f"{name}_gap"))
    return fact.groupBy("time_of_day").agg(
        F.count_if(d).alias("disrupted_trips"), F.count_if(n).alias("normal_trips"), *out)
