"""Landing raw batches in a lake laid out as {root}/{source}/year=YYYY/month=MM.

A batch is one month of one source, and its folder is named by the batch, not by
the rows: a stray row of another month stays in the batch that brought it
and touches no other one. Loading a batch again replaces exactly its folder (the warehouse
loads appended, and a rerun doubled the rows).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

PIPELINE_VERSION = "1.0.0"


def with_audit(df: DataFrame, source: str, ingested_at: str, pipeline_version: str = PIPELINE_VERSION,
               environment: str = "development") -> DataFrame:
    """Stamp every landed row with its load metadata."""
    return df.withColumns({
        "_ingested_at": F.lit(ingested_at).cast("string"),
        "_source": F.lit(source),
        "_pipeline_version": F.lit(pipeline_version),
        "_environment": F.lit(environment),
    })


def load_month(df: DataFrame, root: str, source: str, year: int, month: int, ts: Column | str | None = None,
               cluster_by: list[str] | None = None) -> str:
    """Replace one batch, {root}/{source}/year=/month=, by `df`; returns the batch's folder.

    With `ts` the batch is split into day=YYYY-MM-DD folders by that time (rows without one go to the
    default folder). Rows are rebalanced by day, so AQE makes files of the advisory size: a busy day, or a
    zone pair that holds most of it, becomes several tasks and files. `cluster_by` sorts inside each file, so Parquet
    statistics skip row groups on zone filters. Without `ts` (alerts) the batch is a plain folder.
    """
    path = f"{root.rstrip('/')}/{source}/year={int(year):04d}/month={int(month):02d}"
    parts = []
    if ts is not None:
        t = F.col(ts) if isinstance(ts, str) else ts
        df = df.withColumn("day", F.date_format(t, "yyyy-MM-dd"))
        parts = ["day"]
    out = df.hint("rebalance", *[F.col(p) for p in parts])
    if cluster_by:
        out = out.sortWithinPartitions(*parts, *cluster_by)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(path)
    return path


def load_months(df: DataFrame, root: str, source: str, ts: Column) -> str:
    """Replace all months that `df` reaches into by one write; other months stay. Rows without a time are left out
    (`Lake.land` keeps them as rejects)."""
    path = f"{root.rstrip('/')}/{source}"
    parts = {"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM")}
    (df.where(ts.isNotNull()).withColumns(parts).hint("rebalance", F.col("year"), F.col("month"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
    return path


def append_alerts(df: DataFrame, root: str, source: str, batch_id: str) -> str:
    """The alert table without date partitions: one folder per batch, which a rerun replaces; as many files as its bytes ask for."""
    path = f"{root.rstrip('/')}/{source}/batch={batch_id}"
    df.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


MANIFEST = ("source string, data_year string, data_month string, row_count bigint, column_count bigint, "
            "status string, error string")


def load_all(spark: SparkSession, batches: list, root: str, ingested_at: str,
             environment: str = "development") -> DataFrame:
    """Load a list of batches, each for itself, and report what the lake now holds of them.

    A batch is (source, year, month, DataFrame, options of `load_month`). One manifest row per
    batch: rows and columns read back from its folder, or status 'failed' with the whole error text; a
    batch that fails stops no other one. The manifest is also appended to {root}/_audit.
    """
    rows = []
    for source, year, month, df, opts in batches:
        at = (source, f"{int(year):04d}", f"{int(month):02d}")
        try:
            path = load_month(with_audit(df, source, ingested_at, environment=environment), root, source, year, month, **(opts or {}))
            landed = spark.read.parquet(path)
            rows.append((*at, landed.count(), len(df.columns), "success", None))
        except Exception as exc:  # noqa: BLE001  one failing batch must not stop the others; its error is kept
            log.error("load failed: %s: %s", at, exc)
            rows.append((*at, 0, len(df.columns), "failed", str(exc)))
    out = spark.createDataFrame(rows, MANIFEST)
    out.withColumn("_ingested_at", F.lit(ingested_at)).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_audit")
    return out


def load_summary(manifest: DataFrame) -> DataFrame:
    """Success / total over the batches of a manifest."""
    return manifest.agg(F.count_if(F.col("status") == "success").alias("successful"), F.count(F.lit(1)).alias("total"))
