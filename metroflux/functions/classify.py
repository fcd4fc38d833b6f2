"""Label and score expressions (first matching rule wins, as a CASE does)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metroflux.functions.numeric import round1_exact
from metroflux.schemas import (BOROUGH_RANKS, COMPOUND_SEVERITIES, DEMAND_CATEGORIES, DISTANCE_BUCKETS,
                               DISTANCE_EDGES, DURATION_BUCKETS, DURATION_EDGES, EFFECT_SCORES,
                               RAIN_SEVERITIES, SNOW_SEVERITIES, WEATHER_RULES)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(value, pairs, default) -> Column:
    v = _c(value)
    expr = None
    for key, out in pairs:
        expr = F.when(v == key, out) if expr is None else expr.when(v == key, out)
    return expr.otherwise(default)


# --- weather -----------------------------------------------------------------

def _first_rule(rules, measures: dict, out: int, default) -> Column:
    """Output number `out` of the first rule (measure, comparison, limit, outputs...) that holds."""
    test = {">": lambda c, x: c > x, "<": lambda c, x: c < x}
    return F.coalesce(*[F.when(test[r[1]](measures[r[0]], r[2]), F.lit(r[out])) for r in rules], F.lit(default))


def weather_severity(snow="snowfall_cm", rain="precipitation_mm", temp="temperature_celsius",
                     rules=WEATHER_RULES) -> Column:
    """The severity of the first rule met; an hour with no measures at all is 'clear'."""
    return _first_rule(rules, {"snow": _c(snow), "rain": _c(rain), "temp": _c(temp)}, 3, "clear")


def celsius_to_fahrenheit(c) -> Column:
    return round1_exact(_c(c).cast("decimal(18,4)") * 9 / 5 + 32)


def weather_impact_score(snow="snowfall_cm", rain="precipitation_mm", temp="temperature_celsius",
                         rules=WEATHER_RULES) -> Column:
    """The score of the first rule met, 1 for an hour that meets none."""
    return _first_rule(rules, {"snow": _c(snow), "rain": _c(rain), "temp": _c(temp)}, 4, 1).cast("bigint")


def precipitation_type(snow="snowfall_cm", rain="precipitation_mm") -> Column:
    s, r = _c(snow), _c(rain)
    return (F.when((s > 0) & (r > 0), "snow_and_rain").when(s > 0, "snow_only")
            .when(r > 0, "rain_only").otherwise("dry"))


def is_snow_severity(sev="weather_severity") -> Column:
    return F.when(_c(sev).isin(*SNOW_SEVERITIES), True).otherwise(False)


def is_rain_severity(sev="weather_severity") -> Column:
    return F.when(_c(sev).isin(*RAIN_SEVERITIES), True).otherwise(False)


def is_compound(severe_count, sev="weather_severity") -> Column:
    return F.when((_c(severe_count) > 0) & _c(sev).isin(*COMPOUND_SEVERITIES), True).otherwise(False)


# --- alerts ------------------------------------------------------------------

def disruption_score(effect="effect") -> Column:
    return _lookup(effect, EFFECT_SCORES, 0).cast("bigint")


# --- trips -------------------------------------------------------------------

def ladder(value, edges, labels, closed: bool = False) -> Column:
    """The label of the step that a value stands on: labels[i] lies below edges[i], the last label above them all.

    With `closed` the last edge itself belongs to the step below it. NULL takes the last label.
    """
    v = _c(value)
    below = [v < e for e in edges[:-1]] + [v <= edges[-1] if closed else v < edges[-1]]
    return F.coalesce(*[F.when(b, label) for b, label in zip(below, labels)], F.lit(labels[-1]))


def duration_bucket(minutes="trip_duration_minutes", edges=DURATION_EDGES, labels=DURATION_BUCKETS) -> Column:
    return ladder(minutes, edges, labels)


def distance_bucket(miles="trip_distance_miles", edges=DISTANCE_EDGES, labels=DISTANCE_BUCKETS) -> Column:
    return ladder(miles, edges, labels, closed=True)


def fare_band(fare="fare_amount", edges=(50.0, 100.0, 150.0)) -> Column:
    """Histogram band of a fare: under the first edge, [a, b) between edges with the
    last band closed at the top edge (the staging cap), and over the top edge."""
    f = _c(fare)
    name = lambda x: str(int(x)) if float(x).is_integer() else str(x)
    expr = F.when(f < edges[0], f"under_{name(edges[0])}")
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        upper = (f <= b) if i == len(edges) - 2 else (f < b)
        expr = expr.when((f >= a) & upper, f"{name(a)}_to_{name(b)}")
    return expr.when(f > edges[-1], f"over_{name(edges[-1])}")


# --- zones -------------------------------------------------------------------

def borough_rank(borough="Borough") -> Column:
    return _lookup(borough, BOROUGH_RANKS, 99).cast("bigint")


def demand_category(service_zone="service_zone") -> Column:
    return _lookup(service_zone, DEMAND_CATEGORIES, "other")
