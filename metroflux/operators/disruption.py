"""Subway alerts expanded to hours and joined to zone-hour demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroflux.functions import calendar as cal
from metroflux.functions.classify import is_compound
from metroflux.operators.joins import bounded_broadcast
from metroflux.schemas import EFFECT_SCORES, MODERATE_SCORE, SEVERE_SCORE

# every score that an alert can have: the fixed ones of its effect, and 0 for any other effect
SCORES = tuple(sorted({score for _, score in EFFECT_SCORES} | {0}))


def alert_hours(alerts: DataFrame) -> DataFrame:
    """Start and end hour of each staged alert."""
    return alerts.select(
        "alert_date", "subway_line", "cause", "effect", "disruption_severity_score", "is_synthetic",
        F.hour("alert_start_datetime").cast("bigint").alias("alert_start_hour"),
        F.hour("alert_end_datetime").cast("bigint").alias("alert_end_hour"),
        "alert_duration_minutes",
        "alert_start_datetime", "alert_end_datetime",
    )


def explode_hours(df: DataFrame, across_midnight: bool = False, date_col: str = "alert_date",
                  hour_col: str = "hour_of_day") -> DataFrame:
    """One row per covered hour, start hour to end hour inclusive.

    Default: hours of the start date only, from the start hour to
    min(end hour, 23); an alert whose end hour is before its start hour
    (it crosses midnight) covers no hour, as in the source model.
    `across_midnight=True` walks real hours from the truncated start to the
    end timestamp and takes date and hour from each.
    """
    if not across_midnight:
        lo, hi = F.col("alert_start_hour"), F.least(F.col("alert_end_hour"), F.lit(23))
        ok = lo.isNotNull() & F.col("alert_end_hour").isNotNull() & (lo <= hi)
        return df.where(ok).select("*", F.explode(F.sequence(lo, hi)).alias(hour_col))
    start = cal.truncate_hour("alert_start_datetime")
    end = F.col("alert_end_datetime")
    ok = start.isNotNull() & end.isNotNull() & (start <= end)
    step = F.expr("INTERVAL 1 HOUR")
    hours = F.explode(F.sequence(start, cal.truncate_hour(end), step)).alias("_h")
    out = df.where(ok).select("*", hours)
    return (out.withColumn(date_col, F.to_date("_h"))
               .withColumn(hour_col, F.hour("_h").cast("bigint")).drop("_h"))


def covered_span(df: DataFrame, across_midnight: bool = False) -> DataFrame:
    """`df` with the first and the last covered hour (`first_hour`, `last_hour`); alerts that cover none go. The rules are those of
    `explode_hours`."""
    if across_midnight:
        lo, hi = cal.truncate_hour("alert_start_datetime"), cal.truncate_hour("alert_end_datetime")
        ok = F.col("alert_start_datetime").isNotNull() & (lo <= F.col("alert_end_datetime"))
    else:
        day = F.col("alert_date").cast("timestamp_ntz")
        last = F.least(F.col("alert_end_hour"), F.lit(23))
        lo, hi = F.timestamp_add("HOUR", F.col("alert_start_hour"), day), F.timestamp_add("HOUR", last, day)
        ok = F.col("alert_end_hour").isNotNull() & (F.col("alert_start_hour") <= last)
    return df.where(ok).select("*", lo.alias("first_hour"), hi.alias("last_hour"))


def _changes(spans: DataFrame) -> DataFrame:
    """Two rows per alert: +1 at its first hour, -1 at the hour after its last."""
    start = F.struct(F.col("first_hour").alias("at"), F.lit(1).alias("d"))
    after = F.struct(F.timestamp_add("HOUR", F.lit(1), F.col("last_hour")).alias("at"), F.lit(-1).alias("d"))
    return spans.select("*", F.explode(F.array(start, after)).alias("_c")).select("*", "_c.at", "_c.d").drop("_c")


def _line_changes(changes: DataFrame) -> DataFrame:
    """(at, d): +1 where a line's first running alert starts, -1 where its last one has ended."""
    by_line = Window.partitionBy("subway_line").orderBy("at")
    net = changes.where(F.col("subway_line").isNotNull()).groupBy("subway_line", "at").agg(F.sum("d").alias("d"))
    running = net.withColumn("n", F.sum("d").over(by_line))  # alerts of the line that run from this hour on
    before = running.withColumn("before", F.col("n") - F.col("d"))
    step = F.when((F.col("before") == 0) & (F.col("n") > 0), 1).when((F.col("before") > 0) & (F.col("n") == 0), -1)
    return before.select("at", step.alias("lines")).where(F.col("lines").isNotNull())


def hourly_disruptions(alerts: DataFrame, across_midnight: bool = False, scores: tuple = SCORES) -> DataFrame:
    """Per date and hour, severe and moderate alert counts, lines, worst score, synthetic.

    A sweep over the hours: each alert is two changes of counters, whatever its length, and the counters' running sums
    hold from one hour with changes to the next. Lines are counted by a sweep of their own, the worst score by a counter per
    score in `scores`, the flag by counters of its true and false values. Changes are added up per
    hour inside the map tasks, so the running sums go over one row per hour (and per line and hour) at most, and
    only the result is one row per covered hour: work grows with alerts plus hours, not with their product.
    """
    changes = _changes(covered_span(alert_hours(alerts), across_midnight))
    score, flag, d = F.col("disruption_severity_score"), F.col("is_synthetic"), F.col("d")
    counters = {"severe": F.when(score >= SEVERE_SCORE, d), "moderate": F.when(score >= MODERATE_SCORE, d), "alerts": d,
                "true": F.when(flag, d), "false": F.when(~flag, d), **{f"score{s}": F.when(score == s, d) for s in scores}}
    lines = _line_changes(changes)
    both = changes.select("at", *[c.alias(n) for n, c in counters.items()], F.lit(None).cast("int").alias("lines")).unionByName(
        lines, allowMissingColumns=True)
    names = [*counters, "lines"]
    per_hour = both.groupBy("at").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    hours = Window.orderBy("at")  # a row per hour that anything changes in
    until = F.timestamp_add("HOUR", F.lit(-1), F.lead("at").over(hours))
    running = per_hour.select("at", until.alias("until"), *[F.sum(n).over(hours).alias(n) for n in names]).where(F.col("alerts") > 0)
    each = running.select("*", F.explode(F.sequence("at", "until", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return each.select(
        F.to_date("hour").alias("alert_date"), F.hour("hour").cast("bigint").alias("hour_of_day"),
        F.col("severe").alias("severe_alert_count"), F.col("moderate").alias("moderate_alert_count"),
        F.col("lines").alias("lines_affected"),
        F.coalesce(*[F.when(F.col(f"score{s}") > 0, F.lit(s)) for s in sorted(scores, reverse=True)]).cast("bigint").alias("max_severity_score"),
        F.when(F.col("true") > 0, True).when(F.col("false") > 0, False).alias("has_synthetic_data"))


IMPACT_DEMAND_COLUMNS = [
    "pickup_date", "pickup_hour", "pickup_location_id", "trip_count", "avg_fare",
    "avg_duration_minutes", "avg_speed_mph", "total_fare_revenue", "weather_severity",
    "temperature_celsius", "snowfall_cm", "precipitation_mm",
]


def subway_impact(demand: DataFrame, disruptions: DataFrame, at_most_rows: int | None = None) -> DataFrame:
    """Zone-hour demand with the city-wide disruption of that date-hour.

    The disruption side has one row per date and hour. `at_most_rows` is the number of
    hours it can cover when it is cut to a window; it is then broadcast and demand
    keeps its partitioning.
    """
    h = bounded_broadcast(disruptions, at_most_rows).alias("h")
    d = demand.alias("d")
    j = d.join(h, (F.col("d.pickup_date") == F.col("h.alert_date"))
               & (F.col("d.pickup_hour") == F.col("h.hour_of_day")), "left")
    severe = F.col("h.severe_alert_count")
    return j.select(
        *[F.col(f"d.{c}") for c in IMPACT_DEMAND_COLUMNS],
        F.coalesce(severe, F.lit(0)).alias("severe_subway_alerts"),
        F.coalesce(F.col("h.moderate_alert_count"), F.lit(0)).alias("moderate_subway_alerts"),
        F.coalesce(F.col("h.lines_affected"), F.lit(0)).alias("subway_lines_affected"),
        F.coalesce(F.col("h.max_severity_score"), F.lit(0)).cast("bigint").alias("max_disruption_severity"),
        F.coalesce(F.col("h.has_synthetic_data"), F.lit(False)).alias("has_synthetic_mta_data"),
        F.when(severe > 0, True).otherwise(False).alias("has_subway_disruption"),
        is_compound(severe, F.col("d.weather_severity")).alias("is_compound_disruption"),
    )
