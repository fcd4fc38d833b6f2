"""Batches whose columns drift: the lattice of types, reading by footers, feeds of a lake."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflux.operators.quality import SchemaValidationError
from metroflux.schemas import TRIPS_RAW
from metroflux.sources.drift import least_type, merge_schemas, read_drifting, schemas_of
from metroflux.sources.lake import Lake
from metroflux.sources.readers import read_trips
from test_units import trip

AT = "2026-01-01T00:00:00"
PICKUP = "tpep_pickup_datetime"
TYPES = [T.NullType(), T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2),
         T.DecimalType(12, 2), T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.StringType()]


def test_types_form_a_lattice():
    for a, b, c in itertools.product(TYPES, repeat=3):
        assert least_type(a, a) == a and least_type(a, b) == least_type(b, a)
        assert least_type(least_type(a, b), c) == least_type(a, least_type(b, c)), (a, b, c)
    assert least_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert least_type(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert least_type(T.DateType(), T.TimestampType()) == T.TimestampNTZType()
    assert least_type(T.BooleanType(), T.LongType()) == T.StringType()


def test_names_meet_without_case_under_the_contracts_spelling(spark):
    of = lambda ddl: T.StructType.fromDDL(ddl)
    got = merge_schemas([of("fee int, b string"), of("FEE double, c date")], of("a long, Fee long"))
    assert got.simpleString() == "struct<a:bigint,Fee:double,b:string,c:date>"
    assert merge_schemas([of("fee int"), of("FEE long")]).simpleString() == "struct<fee:bigint>"


def month(spark, path, n, extra, **columns):
    """A month's file of trips with some columns changed; NULL drops a column."""
    df = spark.createDataFrame([trip(tpep_pickup_datetime=dt.datetime(2025, n, d, 9), passenger_count=d) for d in (1, 2)], TRIPS_RAW)
    for name, to in columns.items():
        df = df.drop(name) if to is None else df.withColumn(name, F.col(name).cast(to))
    for old, new in extra.items():
        df = df.withColumnRenamed(old, new)
    df.coalesce(1).write.mode("append").parquet(path)


def test_batches_are_read_as_written_and_brought_together(spark, tmp_path):
    at = lambda n: f"{tmp_path}/{n}"
    month(spark, at(1), 1, {})
    month(spark, at(2), 2, {})
    month(spark, at(3), 3, {"Airport_fee": "airport_fee"}, passenger_count="double", RatecodeID="int")
    month(spark, at(4), 4, {}, passenger_count="double", cbd_congestion_fee=None)
    rows, drift = read_drifting(spark, {f"2025-0{n}": [at(n)] for n in (1, 2, 3, 4)}, TRIPS_RAW)
    assert rows.columns == TRIPS_RAW.names and dict(rows.dtypes)["passenger_count"] == "double"
    assert sorted((r[PICKUP].month, r.passenger_count) for r in rows.collect()) == [(n, float(d)) for n in (1, 2, 3, 4) for d in (1, 2)]
    assert rows.where("RatecodeID is null or Airport_fee is null").count() == 0
    assert rows.where("cbd_congestion_fee is null").count() == 2
    assert {tuple(r) for r in drift.collect()} == {
        ("2025-01", "passenger_count", "type", "bigint", "double"), ("2025-02", "passenger_count", "type", "bigint", "double"),
        ("2025-03", "RatecodeID", "type", "int", "bigint"), ("2025-03", "Airport_fee", "name", "airport_fee", "Airport_fee"),
        ("2025-04", "cbd_congestion_fee", "missing", None, "double")}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3  # January and February are one scan


def test_files_of_one_folder_that_cannot_be_merged_are_halved(spark, tmp_path):
    path = f"{tmp_path}/trips"
    for n in range(1, 7):
        month(spark, path, n, {}, **({"passenger_count": "double"} if n > 4 else {}))
    files = sorted(spark.read.parquet(path).inputFiles())
    parts = schemas_of(spark, files)
    assert sorted(f for some, _ in parts for f in some) == files and 2 <= len(parts) <= 6
    got = read_trips(spark, path, infer=True)
    assert dict(got.dtypes)["passenger_count"] == "double" and got.agg(F.sum("passenger_count")).first()[0] == 18.0


def test_a_file_without_a_required_column_fails(spark, tmp_path):
    month(spark, f"{tmp_path}/a", 1, {})
    month(spark, f"{tmp_path}/b", 2, {}, fare_amount=None)
    with pytest.raises(SchemaValidationError, match="b lacks fare_amount"):
        read_drifting(spark, {n: [f"{tmp_path}/{n}"] for n in "ab"}, TRIPS_RAW, ["FARE_amount", "trip_distance"])


def test_feeds_of_a_lake_may_drift(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = lambda m: spark.createDataFrame([trip(tpep_pickup_datetime=dt.datetime(2025, m, 1)), trip(tpep_pickup_datetime=None)], TRIPS_RAW)
    lake.land("trips", rows(1), PICKUP, AT, feed="january")
    lake.land("trips", rows(2).withColumn("passenger_count", F.lit(2.5)).withColumnRenamed("Airport_fee", "airport_fee"),
              PICKUP, AT, feed="february")
    lake.land("trips", rows(3), PICKUP, AT, feed="march")
    got = lake.read("trips", TRIPS_RAW)
    assert {"Airport_fee", "year", "month", "day"} <= set(got.columns) and "airport_fee" not in got.columns
    assert sorted(r.passenger_count for r in got.collect())[-1] == 2.5 and got.count() == 3
    assert lake.rejects("trips").count() == 3
    assert {(r.batch, r.column_name, r.kind) for r in lake.drift("trips", TRIPS_RAW).collect()} >= {
        ("february", "Airport_fee", "name"), ("january", "passenger_count", "type"), ("march", "passenger_count", "type")}
    lake.land("trips", rows(2), PICKUP, AT, feed="february")  # delivered again as it should be: the drift is gone
    assert lake.drift("trips").count() == 0
