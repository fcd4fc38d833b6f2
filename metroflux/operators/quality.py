"""Data-quality checks: arrival checks on batches and tests on built models.

not_null and row-level singular checks of one model are evaluated together in ONE
aggregation pass over the model with a `count_if` per test. accepted_values tests of
a model are a second pass: failing (test, value) pairs are filtered out of each row
and only those are grouped. `unique` needs a group-by per column; it uses partial
aggregation, and only duplicated values leave the aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.functions import calendar as cal
from metroflux.functions.numeric import ratio_rounded
from metroflux.schemas import FRESHNESS_ERROR_DAYS, FRESHNESS_WARN_DAYS

# ---------------------------------------------------------------------------
# arrival checks
# ---------------------------------------------------------------------------


class SchemaValidationError(ValueError):
    pass


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Fail when a required column is missing; returns `df` unchanged."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaValidationError(f"the batch lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """`df`, which fails when it runs if a key occurs twice; the message names the key. For dimensions."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    text = F.concat(F.lit(f"{', '.join(keys)} occurs more than once: "),
                    F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("_copies", n).where(
        F.when(F.col("_copies") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))).drop("_copies")


def batch_stats(df: DataFrame, year: str, month: str, required: list[str] | None = None) -> DataFrame:
    """One row: row and column count of a landed batch with its year and month."""
    if required is not None:
        require_columns(df, required)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.lit(year).alias("data_year"),
        F.lit(month).alias("data_month"),
        F.lit(required is not None).alias("schema_validated"),
    )


def hour_completeness(weather: DataFrame, ts: str = "weather_datetime") -> DataFrame:
    """B03 + B05: per month, hourly rows against 24 x days in the month."""
    y, m = F.year(ts), F.month(ts)
    g = weather.groupBy(y.cast("bigint").alias("data_year"), m.cast("bigint").alias("data_month")).agg(
        F.count(F.lit(1)).alias("row_count"))
    return g.select(
        "data_year", "data_month",
        cal.month_first_day("data_year", "data_month").alias("first_day"),
        cal.month_last_day("data_year", "data_month").alias("last_day"),
        "row_count",
        cal.hours_in_month("data_year", "data_month").alias("expected_hours"),
        (F.col("row_count") == cal.hours_in_month("data_year", "data_month")).alias("completeness_check"),
    )


def alert_profile(alerts: DataFrame) -> DataFrame:
    """Rows, distinct lines, and whether the batch carries the synthetic-data column."""
    return alerts.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("subway_line").alias("unique_lines_affected"),
    ).withColumn("is_synthetic", F.lit("is_synthetic" in alerts.columns))


# ---------------------------------------------------------------------------
# model tests
# ---------------------------------------------------------------------------

def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    """rows where `column` is NULL."""
    return df.where(F.col(column).isNull())


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """values of `column` that occur more than once (NULL ignored)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def dq_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """values of `column` outside the accepted list, with counts (NULL passes)."""
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def dq_freshness(df: DataFrame, loaded_at: str, *as_of: str, warn_days: int = FRESHNESS_WARN_DAYS,
                 error_days: int = FRESHNESS_ERROR_DAYS) -> DataFrame:
    """age of the newest `loaded_at` at each `as_of` (arguments, never the clock); the table is read once."""
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    asof = F.explode(F.array(*[F.lit(t).cast("timestamp_ntz") for t in as_of]))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("snapshotted_at"))
    return newest.select("max_loaded_at", asof.alias("snapshotted_at")).select(
        "max_loaded_at", "snapshotted_at", age.alias("max_loaded_at_time_ago_in_s"),
        F.when(age > error_days * 86400, "error").when(age > warn_days * 86400, "warn")
         .otherwise("pass").alias("status"))


def dq_orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str, keep: list[str] | None = None) -> DataFrame:
    """fact rows whose `fk` has no `pk` in the dimension (left anti join)."""
    # no distinct: an anti join needs none, and a plain shuffle join lets AQE split a hot foreign key
    keys = dim.select(F.col(pk).alias("_pk"))
    return fact.join(keys, F.col(fk) == F.col("_pk"), "left_anti").select(*(keep or fact.columns))


def dq_coverage(df: DataFrame, column: str = "weather_severity",
                keep: tuple = ("trip_id", "pickup_datetime", "weather_severity")) -> DataFrame:
    """rows with no value in `column` (e.g. trips whose weather join failed)."""
    return df.where(F.col(column).isNull()).select(*keep)


def amount_inconsistent() -> Column:
    return F.col("total_amount") < F.col("fare_amount")


def dq_amount_consistency(fact: DataFrame) -> DataFrame:
    """total below fare, with the adjustment amount (warn)."""
    return fact.where(amount_inconsistent()).select(
        "trip_id", "fare_amount", "total_amount",
        F.round(F.col("fare_amount") - F.col("total_amount"), 2).alias("adjustment_amount"))


def impossible_speed(min_miles: float = 100, max_minutes: int = 30) -> Column:
    return (F.col("trip_distance_miles") > min_miles) & (F.col("trip_duration_minutes") < max_minutes)


def dq_impossible_speed(fact: DataFrame, min_miles: float = 100, max_minutes: int = 30) -> DataFrame:
    """more than `min_miles` in under `max_minutes` (warn); speed NULL at 0 minutes."""
    return fact.where(impossible_speed(min_miles, max_minutes)).select(
        "trip_id", "trip_distance_miles", "trip_duration_minutes",
        ratio_rounded("trip_distance_miles", "trip_duration_minutes", 1, scale_by=60).alias("implied_speed_mph"))


# ---------------------------------------------------------------------------
# suite runner
# ---------------------------------------------------------------------------

@dataclass
class Test:
    name: str
    model: str
    kind: str                      # not_null | unique | accepted_values | expression | orphans
    column: str | None = None
    values: list = field(default_factory=list)
    severity: str = "error"
    where: str | None = None       # kind == expression: SQL predicate selecting failing rows
    ref: tuple | None = None       # kind == orphans: (dim model, fk, pk)


def _failures_one_pass(df: DataFrame, tests: list[Test]) -> DataFrame:
    """Failing rows of not_null and expression tests on one model, in a single aggregation."""
    failing = {t.name: F.col(t.column).isNull() if t.kind == "not_null" else F.expr(t.where) for t in tests}
    wide = df.agg(*[F.count_if(c).alias(name) for name, c in failing.items()])
    pairs = ", ".join(f"'{t.name}', `{t.name}`" for t in tests)
    return wide.selectExpr(f"stack({len(tests)}, {pairs}) as (test_name, failures)")


def _unaccepted(df: DataFrame, tests: list[Test]) -> DataFrame:
    """Distinct unaccepted values of accepted_values tests on one model; tests without any give no row."""
    pairs = [F.when(~F.col(t.column).isin(*t.values),
                    F.struct(F.lit(t.name).alias("test_name"), F.col(t.column).cast("string").alias("value")))
             for t in tests]
    bad = df.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.*").distinct()
    return bad.groupBy("test_name").agg(F.count(F.lit(1)).alias("failures"))


def run_suite(models: dict[str, DataFrame], tests: list[Test]) -> DataFrame:
    """one row per test: model, severity, failures, status (PASS / WARN / ERROR)."""
    parts = []
    by_model: dict[tuple[str, bool], list[Test]] = {}
    for t in tests:
        if t.kind in ("not_null", "accepted_values", "expression"):
            by_model.setdefault((t.model, t.kind == "accepted_values"), []).append(t)
    for (model, accepted), ts in by_model.items():
        parts.append((_unaccepted if accepted else _failures_one_pass)(models[model], ts))
    for t in tests:
        if t.kind == "unique":
            parts.append(dq_unique(models[t.model], t.column)
                         .agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(t.name).alias("test_name"), "failures"))
        elif t.kind == "orphans":
            dim, fk, pk = t.ref
            parts.append(dq_orphans(models[t.model], models[dim], fk, pk, keep=[fk])
                         .agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(t.name).alias("test_name"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    info = out.sparkSession.createDataFrame(
        [(t.name, t.model, t.kind, t.severity) for t in tests],
        "test_name string, model string, test_type string, severity string")
    j = info.join(out, "test_name", "left").withColumn("failures", F.coalesce("failures", F.lit(0)).cast("bigint"))
    return j.select(
        "test_name", "model", "test_type", "severity", "failures",
        F.when(F.col("failures") == 0, "PASS").when(F.col("severity") == "warn", "WARN")
         .otherwise("ERROR").alias("status"))


def summarize(report: DataFrame) -> DataFrame:
    """PASS / WARN / ERROR counts plus a TOTAL row."""
    # one aggregation: the rollup's grand-total row (status NULL) is the TOTAL
    r = report.rollup("status").agg(F.count(F.lit(1)).alias("tests"), F.grouping("status").alias("_g"))
    return r.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("status")).alias("status"), "tests")
