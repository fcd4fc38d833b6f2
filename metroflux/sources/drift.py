"""Batches whose columns drift from month to month, read under one schema that holds them all.

A feed's files carry their own schema in their footers. Over the years a column turns from whole numbers to doubles,
changes the case of its name, appears or goes. Each batch is read with the types it was written with, and only then
brought to the merged schema: the least type that holds what every batch has (see `least_type`), under the
contract's spelling. Batches written alike are one scan, however many months they are.

Footers are merged by Spark. Files that cannot be merged are halved, in the order of their names, until each part
can be, so a feed that changed a few times takes a few footer reads, not one per file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflux.operators.quality import SchemaValidationError

DRIFT = "batch string, column_name string, kind string, found string, merged string"

# types of a family widen to the later one
WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
REAL = [T.FloatType(), T.DoubleType()]
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def least_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds both; the order in which types are merged does not matter.

    Whole numbers widen to the larger; any other two numbers meet in a double (whose exact integers end at 2^53). Dates
    and both kinds of timestamps meet in the timestamp without a zone, a column that was empty takes the other's type,
    and whatever has nothing in common becomes text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for family in (WHOLE, REAL):
        if a in family and b in family:
            return family[max(family.index(a), family.index(b))]
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.TimestampNTZType() if isinstance(a, TIMES) and isinstance(b, TIMES) else T.StringType()


def merge_schemas(schemas: list[T.StructType], contract: T.StructType | None = None) -> T.StructType:
    """The least schema that holds all; names are told apart without case, and the contract, else the first, spells them."""
    merged: dict[str, T.StructField] = {}
    for f in (f for schema in [contract or T.StructType(), *schemas] for f in schema.fields):
        known = merged.get(f.name.lower())
        merged[f.name.lower()] = (T.StructField(known.name, least_type(known.dataType, f.dataType)) if known
                                  else T.StructField(f.name, f.dataType))
    return T.StructType(list(merged.values()))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with the columns of `schema`: found whatever their case, cast to its types, NULL where `df` lacks them."""
    own = {c.lower(): c for c in df.columns}
    at = lambda f: F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)
    return df.select(*[at(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def union_drifting(frames: list[DataFrame], contract: T.StructType | None = None) -> DataFrame:
    """Frames of drifting columns as one, under their merged schema."""
    if len(frames) == 1 and contract is None:
        return frames[0]
    merged = merge_schemas([df.schema for df in frames], contract)
    return reduce(DataFrame.unionByName, [conform(df, merged) for df in frames])


def departures(batch: str, found: T.StructType, merged: T.StructType) -> list[tuple]:
    """How a batch departs from the merged schema: rows of DRIFT, of the kinds `type`, `name` (its case) and `missing`."""
    own = {f.name.lower(): f for f in found.fields}
    out = []
    for f in merged.fields:
        has = own.get(f.name.lower())
        if has is None:
            out.append((batch, f.name, "missing", None, f.dataType.simpleString()))
            continue
        if has.name != f.name:
            out.append((batch, f.name, "name", has.name, f.name))
        if has.dataType != f.dataType:
            out.append((batch, f.name, "type", has.dataType.simpleString(), f.dataType.simpleString()))
    return out


def drift_report(spark: SparkSession, found: list[tuple[str, T.StructType]], contract: T.StructType | None = None) -> DataFrame:
    """A row per batch and departure. Columns beyond the contract show as missing from the batches without them."""
    merged = merge_schemas([schema for _, schema in found], contract)
    return spark.createDataFrame(sorted({d for name, s in found for d in departures(name, s, merged)}, key=str), DRIFT)


def schemas_of(spark: SparkSession, files: list[str]) -> list[tuple[list[str], T.StructType]]:
    """(files, schema) of parts, found by halving, whose footers Spark can merge."""
    try:
        return [(files, spark.read.option("mergeSchema", "true").parquet(*files).schema)]
    except Exception as e:  # raised by Spark or by its gateway, depending on where the merge failed
        if len(files) == 1 or "CANNOT_MERGE" not in str(e):
            raise
    half = len(files) // 2
    return schemas_of(spark, files[:half]) + schemas_of(spark, files[half:])


def read_drifting(spark: SparkSession, batches: dict[str, list[str]], contract: T.StructType | None = None,
                  required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """All batches (name: its paths) under their merged schema, and their `drift_report`.

    Fails on a file without a `required` column (in any case). Driver work is a few rows per batch and schema. Within a
    batch, names that differ in case only count as the first file has them.
    """
    parts = []
    for name, paths in sorted(batches.items()):
        files = sorted(spark.read.parquet(*paths).inputFiles())
        parts += [(name, some, schema) for some, schema in schemas_of(spark, files)]
    for name, _, schema in parts:
        lacks = {c.lower(): c for c in required or []}.keys() - {f.name.lower() for f in schema.fields}
        if lacks:
            raise SchemaValidationError(f"{name} lacks {', '.join(sorted(lacks))}")
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for _, files, schema in parts:
        alike.setdefault(schema.json(), (schema, []))[1].extend(files)
    scans = [spark.read.schema(schema).parquet(*files) for schema, files in alike.values()]
    return union_drifting(scans, contract), drift_report(spark, [(name, schema) for name, _, schema in parts], contract)
