"""Flatten the JSON feeds (hourly weather arrays, service-alert entities) into raw rows.

Both run as column expressions on the executors: `from_json` with a fixed
schema, then `arrays_zip`/`inline` or `filter`/`explode`. Each JSON document
is one row, so the work spreads over as many tasks as there are documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.schemas import (ALERT_ENTITY_JSON, DEFAULT_CAUSE, DEFAULT_EFFECT, HEADER_MAX_CHARS,
                               SUBWAY_LINES, WEATHER_JSON)

WEATHER_MEASURES = ["temperature_2m", "precipitation", "snowfall", "windspeed_10m", "weathercode", "visibility"]


def _parsed_weather(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).alias("raw_text"), F.from_json(F.col(text_col), WEATHER_JSON).alias("d"))


def flatten_weather_json(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """A10: one row per hour from `{latitude, longitude, timezone, hourly: {time: [...], ...}}`.

    A measure that the document lacks, or has fewer values of than hours, is NULL for those hours.
    """
    d = _parsed_weather(docs, text_col).where(F.col("d.hourly.time").isNotNull())
    rows = d.select("d", F.posexplode("d.hourly.time").alias("i", "datetime_hour"))
    return rows.select("datetime_hour", *[F.get(F.col(f"d.hourly.{c}"), F.col("i")).alias(c) for c in WEATHER_MEASURES],
                       "d.latitude", "d.longitude", "d.timezone")


def weather_rejects(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Weather documents without readable hours."""
    return _parsed_weather(docs, text_col).where(F.col("d.hourly.time").isNull()).select("raw_text")


def _known_routes(entities: Column) -> Column:
    """Route ids of the informed entities that are subway lines, in feed order."""
    routes = F.transform(F.coalesce(entities, F.array()), lambda e: e["route_id"])
    return F.filter(routes, lambda r: r.isin(*SUBWAY_LINES))


def parse_alert_entities(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """One row (raw_text, entity) per entity of each document; malformed text gives `entity` NULL.

    A document is a feed envelope `{"entity": [...]}`, a bare list of entities, or one entity. An entity
    holds its alert under "alert", or is the alert itself; such flat ones are wrapped here.
    """
    text = F.col(text_col)
    listed = F.coalesce(F.from_json(F.get_json_object(text, "$.entity"), "array<string>"),
                        F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>")), F.array(text))
    each = docs.select(F.explode_outer(F.when(F.size(listed) > 0, listed)).alias("raw_text"))
    each = each.where(F.col("raw_text").isNotNull())
    parsed = each.select("raw_text", F.from_json("raw_text", ALERT_ENTITY_JSON).alias("entity"),
                         F.from_json("raw_text", ALERT_ENTITY_JSON["alert"].dataType).alias("flat"))
    is_flat = F.col("entity.alert").isNull() & F.col("flat.informed_entity").isNotNull()
    wrapped = F.struct(F.col("entity.id").alias("id"), F.col("flat").alias("alert"))
    return parsed.select("raw_text", F.when(is_flat, wrapped).otherwise(F.col("entity")).alias("entity"))


def _unreadable() -> Column:
    # PERMISSIVE from_json turns malformed text into a struct of NULLs; an entity without an alert says nothing
    return F.col("entity").isNull() | F.col("entity.alert").isNull()


def alert_rejects(parsed: DataFrame) -> DataFrame:
    """Entities that could not be read (malformed text, or an empty period list)."""
    a = F.col("entity.alert")
    empty_periods = a["active_period"].isNotNull() & (F.size(a["active_period"]) == 0)
    return parsed.where(_unreadable() | empty_periods).select("raw_text")


def alert_rows(docs: DataFrame, text_col: str = "value", ingested_at: str | None = None) -> DataFrame:
    """A11-A14 in one parse: the rows of `flatten_alert_json`, and one row per unreadable entity.

    Accepted rows have `reject` and `raw_text` NULL; rejected ones hold their text and the reason, and no other value.
    """
    parsed = parse_alert_entities(docs, text_col)
    a = F.col("entity.alert")
    empty = a["active_period"].isNotNull() & (F.size(a["active_period"]) == 0)
    reason = F.when(_unreadable(), "unreadable entity").when(empty, "empty period list")
    tagged = parsed.withColumn("reject", reason)
    # one branch per entity: a rejected one is a single line without a name, an accepted one its known lines (none: no row)
    lines = F.when(F.col("reject").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(_known_routes(a["informed_entity"]))
    fine = F.col("reject").isNull()
    values = _alert_columns(a)
    return tagged.select(F.explode(lines).alias("subway_line"), *[F.when(fine, v).alias(n) for n, v in values.items()],
                         F.when(fine, F.lit(ingested_at).cast("string")).alias("ingested_at"), "reject",
                         F.when(~fine, F.col("raw_text")).alias("raw_text"))


def weather_rows(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """A10, A14 in one parse: the rows of `flatten_weather_json`, and one row (`reject`, `raw_text`) per unreadable document."""
    d = _parsed_weather(docs, text_col).withColumn("reject", F.when(F.col("d.hourly.time").isNull(), "no readable hours"))
    times = F.when(F.col("reject").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(F.col("d.hourly.time"))
    rows = d.select("d", "reject", F.when(F.col("reject").isNotNull(), F.col("raw_text")).alias("raw_text"),
                    F.posexplode(times).alias("i", "datetime_hour"))
    return rows.select("datetime_hour", *[F.get(F.col(f"d.hourly.{c}"), F.col("i")).alias(c) for c in WEATHER_MEASURES],
                       "d.latitude", "d.longitude", "d.timezone", "reject", "raw_text")


def _alert_columns(a: Column) -> dict[str, Column]:
    """The values of an alert besides its lines, with their defaults."""
    first_period = F.get(a["active_period"], 0)
    translation = a["header_text"]["translation"]
    header = F.when(F.coalesce(F.size(translation), F.lit(0)) <= 0, F.lit("")).otherwise(F.coalesce(F.get(translation, 0)["text"], F.lit("")))
    return {
        "alert_id": F.coalesce(F.col("entity.id"), F.lit("")),
        "cause": F.coalesce(a["cause"], F.lit(DEFAULT_CAUSE)),
        "effect": F.coalesce(a["effect"], F.lit(DEFAULT_EFFECT)),
        "header_text": F.substring(header, 1, HEADER_MAX_CHARS),
        "start_time": F.coalesce(first_period["start"], F.lit("")),
        "end_time": F.coalesce(first_period["end"], F.lit("")),
    }


def flatten_alert_json(parsed: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """One row per alert x known subway line.

    Alerts naming no known line are dropped. The first active period gives
    start/end (blank when the period list is missing; an empty list makes
    the entity unreadable and it is skipped), the first header translation
    is cut to 500 characters, cause/effect default to UNKNOWN_*.
    """
    a = F.col("entity.alert")
    periods = a["active_period"]
    ok = ~_unreadable() & ~(periods.isNotNull() & (F.size(periods) == 0))
    base = parsed.where(ok).select(_known_routes(a["informed_entity"]).alias("lines"),
                                   *[c.alias(n) for n, c in _alert_columns(a).items()])
    # explode drops alerts whose known-line list is empty
    return base.select(
        "alert_id", F.explode("lines").alias("subway_line"), "cause", "effect", "header_text",
        "start_time", "end_time",
        F.lit(ingested_at).cast("string").alias("ingested_at"),
    )
