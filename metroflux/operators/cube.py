"""The report cube: unfinished measures of trips by the attributes that reports group and slice by.

A row holds, for one combination of month, pickup hour, time of day, disruption, weather severity and holiday window, the number of
trips and for each measure an unfinished exact sum with its non-null count (`numeric.state`). All of these attributes
belong to the hour, so the cube has at most a few rows per hour of the window whatever the trips are. States merge
exactly, so every report below adds up cube rows and gets the very bits that it would get from the trips. The fact is
read once, however many reports follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.functions import numeric as nm
from metroflux.functions.calendar import trip_time_of_day
from metroflux.operators.reports import FLAG

MEASURES = {"fare": "fare_amount", "total": "total_amount", "tip": "tip_amount", "tip_pct": "tip_percentage", "speed": "avg_speed_mph"}
# month_start and analysis_month, the hour and the label that the calendar gives it
KEYS = ["month_start", "analysis_month", "pickup_hour", "time_of_day", FLAG, "weather_severity", "is_holiday_period"]


def build_cube(fact: DataFrame) -> DataFrame:
    """One partial + final aggregation of the trips; a hot hour leaves each map task as one row."""
    states = [s for name, column in MEASURES.items() for s in nm.state(column, name)]
    return fact.withColumn("month_start", F.trunc("pickup_date", "month")).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_duration_minutes").alias("minutes"),
        F.count("trip_duration_minutes").alias("minutes_n"), *states)


def roll_up(cube: DataFrame, *by, more: tuple[Column, ...] = ()) -> DataFrame:
    """Cube rows added up to coarser ones; the result is a cube by `by`, with further aggregates if wanted."""
    merged = [m for name in MEASURES for m in nm.merge(name)]
    plain = [F.sum(c).alias(c) for c in ("trips", "minutes", "minutes_n")]
    grouped = cube.groupBy(*by) if by else cube.groupBy()
    return grouped.agg(*plain, *merged, *more)


def with_trip_label(cube: DataFrame) -> DataFrame:
    """The cube with the seven-part label of the hour next to the calendar's five-part one."""
    return cube.withColumn("trip_time_of_day", trip_time_of_day("pickup_hour"))


# --- finished measures of a rolled-up cube ----------------------------------------------------

def _mean(name: str, places: int) -> Column:
    return F.round(nm.mean(name), places)


def _minutes(places: int) -> Column:
    return F.round(F.try_divide(F.col("minutes").cast("double"), F.nullif(F.col("minutes_n"), F.lit(0))), places)


def kpi(cube: DataFrame) -> DataFrame:
    """Headline row: trips, revenue, average fare, speed, duration, disruption trips."""
    hits = F.coalesce(F.sum(F.when(F.col(FLAG), F.col("trips"))), F.lit(0)).alias("disruption_trips")
    return roll_up(cube, more=(hits,)).select(
        F.coalesce("trips", F.lit(0)).alias("total_trips"), nm.total("total").alias("total_revenue"), _mean("fare", 2).alias("avg_fare"),
        _mean("speed", 1).alias("avg_speed_mph"), _minutes(2).alias("avg_duration_minutes"), "disruption_trips")


def hourly_by_disruption(cube: DataFrame) -> DataFrame:
    """Per pickup hour and disruption status: trips, average fare and speed."""
    return roll_up(cube, "pickup_hour", FLAG).select("pickup_hour", FLAG, "trips", _mean("fare", 2).alias("avg_fare"),
                                                     _mean("speed", 1).alias("avg_speed_mph"))


def fare_by_tod(cube: DataFrame) -> DataFrame:
    """Per time of day and disruption status: average fare, tip and tip %."""
    return roll_up(cube, "time_of_day", FLAG).select("time_of_day", FLAG, _mean("fare", 2).alias("avg_fare"),
                                                     _mean("tip", 2).alias("avg_tip"), _mean("tip_pct", 1).alias("avg_tip_percentage"))


def trips_by_tod(cube: DataFrame) -> DataFrame:
    """Per time of day and disruption status: trips, average fare, speed and minutes."""
    return roll_up(cube, "time_of_day", FLAG).select(
        "time_of_day", FLAG, "trips", _mean("fare", 2).alias("avg_fare"), _mean("speed", 1).alias("avg_speed_mph"),
        _minutes(1).alias("avg_duration_minutes"))


def monthly_volume(cube: DataFrame) -> DataFrame:
    """Per pickup month and disruption status: trips, revenue, average fare."""
    return roll_up(cube, "month_start", "analysis_month", FLAG).select(
        "month_start", "analysis_month", FLAG, "trips", nm.total("total").alias("revenue"), _mean("fare", 2).alias("avg_fare"))


def holiday_split(cube: DataFrame) -> DataFrame:
    """Holiday window against the rest: trips, revenue, average fare."""
    return roll_up(cube, "is_holiday_period").select("is_holiday_period", "trips", nm.total("total").alias("revenue"),
                                                     _mean("fare", 2).alias("avg_fare"))


def disruption_gap(cube: DataFrame) -> DataFrame:
    """Per time of day, disrupted minus normal average fare, speed and minutes."""
    sides = roll_up(cube, "time_of_day", FLAG).select(
        "time_of_day", FLAG, "trips", _mean("fare", 2).alias("fare"), _mean("speed", 2).alias("speed_mph"), _minutes(2).alias("duration_minutes"))
    of = lambda c, hit: F.max(F.when(F.col(FLAG) if hit else ~F.col(FLAG), F.col(c)))  # noqa: E731  at most one row of each
    return sides.groupBy("time_of_day").agg(
        F.coalesce(of("trips", True), F.lit(0)).alias("disrupted_trips"), F.coalesce(of("trips", False), F.lit(0)).alias("normal_trips"),
        *[nm.difference(of(c, True), of(c, False), 2).alias(f"{c}_gap") for c in ("fare", "speed_mph", "duration_minutes")])


def report_pack(cube: DataFrame, sliced: DataFrame) -> DataFrame:
    """All reports as rows (report, slice, measure, value): what a dashboard loads at once. `sliced` is the cube behind its slicers.
    A measure without a value has no row."""
    reports = {"kpi": (kpi(cube), []), "sliced_kpi": (kpi(sliced), []), "hourly_by_disruption": (hourly_by_disruption(cube), ["pickup_hour", FLAG]),
               "fare_by_tod": (fare_by_tod(cube), ["time_of_day", FLAG]), "trips_by_tod": (trips_by_tod(cube), ["time_of_day", FLAG]),
               "monthly_volume": (monthly_volume(cube), ["month_start", "analysis_month", FLAG]),
               "holiday": (holiday_split(cube), ["is_holiday_period"]), "disruption_gap": (disruption_gap(cube), ["time_of_day"])}
    out = None
    for name, (df, keys) in reports.items():
        values = [c for c in df.columns if c not in keys]
        text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
        long = df.select(F.lit(name).alias("report"), text.alias("slice"), *[F.col(c).cast("double").alias(c) for c in values]).unpivot(
            ["report", "slice"], values, "measure", "value")
        out = long if out is None else out.unionByName(long)
    return out.where(F.col("value").isNotNull())
