"""Readers for the raw feeds and the zone seed, each with an explicit contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from metroflux.operators.quality import require_columns
from metroflux.schemas import ALERTS_RAW, TRIPS_RAW, TRIPS_REQUIRED, WEATHER_RAW, ZONES
from metroflux.sources.drift import read_drifting


def _own_schema(spark: SparkSession, path: str) -> DataFrame:
    """The files as they are. A fixed schema alone would read a column that they lack as NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def _under_contract(spark: SparkSession, path: str, contract: T.StructType, optional: tuple = ()) -> DataFrame:
    require_columns(_own_schema(spark, path), [f.name for f in contract.fields if f.name not in optional])
    return spark.read.schema(contract).parquet(path)


def read_trips(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """A01 (+A09, B01): raw trips Parquet that hold the required columns; fails on files without them.

    `infer=True` takes types and further columns from the file footers, merged across months (see `drift`)."""
    if infer:
        return read_drifting(spark, {"trips": [path]}, TRIPS_RAW, TRIPS_REQUIRED)[0]
    require_columns(_own_schema(spark, path), TRIPS_REQUIRED)
    return spark.read.schema(TRIPS_RAW).parquet(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Raw hourly weather with the fixed contract; the hour may be ISO-minute text or a timestamp."""
    hour = next((f for f in _own_schema(spark, path).schema.fields if f.name == "datetime_hour"), None)
    if hour is None or isinstance(hour.dataType, T.StringType):
        return _under_contract(spark, path, WEATHER_RAW)
    typed = T.StructType([T.StructField(f.name, hour.dataType if f.name == "datetime_hour" else f.dataType)
                          for f in WEATHER_RAW.fields])
    return _under_contract(spark, path, typed)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Raw alerts with the fixed contract (is_synthetic may be absent and reads as NULL)."""
    return _under_contract(spark, path, ALERTS_RAW, optional=("is_synthetic", "ingested_at"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone seed CSV; every field is quoted text and 'N/A' is a value, not NULL."""
    return (spark.read.option("header", True).option("quote", '"').option("nullValue", None)
            .schema(ZONES).csv(path))


def read_landed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A landed source with its year=/month= folders. With `schema` no footer is read to find one."""
    reader = spark.read.option("basePath", path)
    return reader.schema(schema).parquet(path) if schema else reader.option("mergeSchema", "true").parquet(path)
