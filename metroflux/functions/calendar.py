"""Calendar and clock expressions over TIMESTAMP_NTZ columns.

Everything here is session-time-zone independent: truncation and epoch
conversion are done with NTZ arithmetic, never through a local-time cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metroflux.schemas import ANALYSIS_MONTHS, HOLIDAY_RANGES


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate_hour(ts) -> Column:
    """Wall-clock hour of an NTZ timestamp, still NTZ."""
    ts = col_(ts)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def minutes_between(start, end) -> Column:
    """Whole minutes from `start` to `end`, truncated toward zero, signed."""
    return F.timestamp_diff("MINUTE", col_(start), col_(end))


def epoch_seconds(ts) -> Column:
    """Epoch seconds of a UTC wall-clock NTZ timestamp."""
    return F.timestamp_diff("SECOND", _epoch(), col_(ts))


def from_epoch_seconds(seconds) -> Column:
    """UTC wall-clock NTZ timestamp from epoch seconds (bigint)."""
    return F.timestamp_add("SECOND", col_(seconds), _epoch())


def parse_iso_minute(text) -> Column:
    """'2025-11-03T22:00' -> TIMESTAMP_NTZ (malformed text fails, as in the source)."""
    return F.to_timestamp_ntz(col_(text), F.lit("yyyy-MM-dd'T'HH:mm"))


def day_of_week(ts) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(col_(ts)).cast("bigint")


def is_weekend(ts) -> Column:
    return F.dayofweek(col_(ts)).isin(1, 7)


def month_first_day(year, month) -> Column:
    return F.make_date(col_(year).cast("int"), col_(month).cast("int"), F.lit(1))


def month_last_day(year, month) -> Column:
    return F.last_day(month_first_day(year, month))


def hours_in_month(year, month) -> Column:
    return (F.dayofmonth(month_last_day(year, month)) * 24).cast("bigint")


def trip_time_of_day(hour) -> Column:
    """Seven-label time of day used on trips."""
    h = col_(hour)
    return (F.when(h.between(4, 8), "early_morning")
            .when(h.between(9, 11), "late_morning")
            .when(h.between(12, 16), "afternoon_peak")
            .when(h.between(17, 19), "evening_peak")
            .when(h.between(20, 23), "late_night")
            .when(h.between(0, 3), "mid_night")
            .otherwise("off_peak"))


def dim_time_of_day(hour) -> Column:
    """Five-label time of day of the time dimension (hour 4 is off_peak here)."""
    h = col_(hour)
    return (F.when(h.between(5, 8), "morning_peak")
            .when(h.between(17, 19), "evening_peak")
            .when(h.between(20, 23), "late_night")
            .when(h.between(0, 3), "mid_night")
            .otherwise("off_peak"))


def is_peak_hour(hour) -> Column:
    h = col_(hour)
    return F.when(h.between(7, 9) | h.between(17, 19), True).otherwise(False)


def analysis_month(month) -> Column:
    """Month name for the analysis months, NULL for any other month."""
    m = col_(month)
    expr = None
    for number, name in ANALYSIS_MONTHS:
        expr = F.when(m == number, name) if expr is None else expr.when(m == number, name)
    return expr


def is_holiday_period(month, day) -> Column:
    m, d = col_(month), col_(day)
    cond = None
    for mon, first, last in HOLIDAY_RANGES:
        c = (m == mon) & d.between(first, last)
        cond = c if cond is None else (cond | c)
    return F.when(cond, True).otherwise(False)
