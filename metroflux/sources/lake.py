"""A lake of landed batches that is replaced safely and loses no row.

    {root}/{source}/version=N/outcome=accepted/year=/month=/day=    rows with a time
    {root}/{source}/version=N/outcome=rejected/...                  rows without one, or that could not be read
    {root}/{source}/version=N/outcome=accepted/                     a source that is not partitioned by time
    {root}/_current                                                 which version holds which batch, and its counts

One landing parses its feed once and writes it once: each row goes to one of two outcomes, with the reason if it is
rejected, and its counts are observed by that same write. Written files are counted from their footers. A landing
writes aside; only when all counts agree, one row per batch is appended to `_current`, in one file, and from then on
readers see the new version. A landing that fails at any point leaves what was there. A feed is what is delivered
together, such as a month's file; landing it again supersedes all that it brought before and nothing else, so a rerun doubles
nothing, and a stray row of another month neither replaces that month nor is lost with it. One landing per source at a time.

Columns may drift between feeds. A landing keeps the schema that it wrote beside its counts, so a reader opens no footer to
learn it: feeds written alike are one scan, and differing ones meet in the least schema that holds them all.

Files are clustered across the whole day by a space-filling curve over the columns that readers filter on, cut
into ranges by a sample, so that minima and maxima in the footers rule most files out. Copies of one point
(a hot pair of zones) are told apart by a hash of the row, so they spread over several files.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflux.functions.curve import curve_key
from metroflux.sources.drift import drift_report, union_drifting
from metroflux.sources.landing import with_audit

CURRENT = ("source string, outcome string, feed string, data_year string, data_month string, version bigint, row_count bigint, "
           "column_count bigint, file_count bigint, by_month boolean, ingested_at string, written string")
NO_TIME = "no time"


class LandingError(RuntimeError):
    pass


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- what is there -------------------------------------------------------------------
    def audit(self) -> DataFrame:
        """Every batch that was ever landed, superseded ones too."""
        try:
            return self.spark.read.schema(CURRENT).parquet(f"{self.root}/_current")
        except AnalysisException:  # nothing has been landed yet
            return self.spark.createDataFrame([], CURRENT)

    def batches(self, source: str | None = None) -> DataFrame:
        """The batches that readers see: what the last landing of each feed brought, by month and outcome."""
        rows = self.audit() if source is None else self.audit().where(F.col("source") == source)
        feed = Window.partitionBy("source", "feed")
        return rows.withColumn("_last", F.max("version").over(feed)).where(F.col("version") == F.col("_last")).drop("_last")

    def _read(self, source: str, outcome: str, contract: T.StructType | None = None) -> DataFrame:
        base = f"{self.root}/{source}"
        hive = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None else v
        alike: dict[str, set[str]] = {}
        rows = self.batches(source).where((F.col("outcome") == outcome) & (F.col("row_count") > 0)).collect()  # a row per month
        for r in sorted(rows, key=lambda r: r.version):
            at = f"{base}/version={r.version}/outcome={outcome}"
            alike.setdefault(r.written, set()).add(
                f"{at}/year={hive(r.data_year)}/month={hive(r.data_month)}" if r.by_month else at)
        if not alike:
            raise LandingError(f"{source} holds no {outcome} rows")
        reader = lambda: self.spark.read.option("basePath", base)
        return union_drifting([reader().schema(_schema(written)).parquet(*sorted(paths)).drop("version", "outcome")
                               for written, paths in alike.items()], contract)

    def read(self, source: str, contract: T.StructType | None = None) -> DataFrame:
        """The accepted rows with their audit columns and year, month, day, under the feeds' merged schema.

        A contract gives the spelling of names and takes part in the merge; without one the feed landed first spells them.
        """
        return self._read(source, "accepted", contract).drop("_reject")

    def drift(self, source: str, contract: T.StructType | None = None) -> DataFrame:
        """How each feed's columns depart from the merged schema, from the audit rows alone."""
        rows = self.batches(source).select("feed", "version", "written").distinct().collect()  # a row per feed
        return drift_report(self.spark, [(r.feed, _schema(r.written)) for r in sorted(rows, key=lambda r: r.version)], contract)

    def rejects(self, source: str) -> DataFrame:
        """The rejected rows; `_reject` says why."""
        return self._read(source, "rejected")

    # --- landing ---------------------------------------------------------------------------
    def land(self, source: str, rows: DataFrame, when: Column | str | None, ingested_at: str, feed: str = "all",
             reject: Column | None = None, near: list[tuple[Column, int]] | None = None, files: int | None = None,
             environment: str = "development") -> DataFrame:
        """Land a feed of any number of months and return its audit rows (also kept in `_current`).

        `when` is a row's time; rows without one, or with a text in `reject`, become rejects. With `when` None the
        source is not partitioned and needs no times. `near` gives the columns that files are clustered by, each with its number of
        bits. `files` is the number of ranges that the feed is cut into; without it Spark's partition sizing decides.
        """
        version = (self.audit().where(F.col("source") == source).agg(F.max("version")).first()[0] or 0) + 1
        reason = F.lit(None).cast("string") if reject is None else reject
        folders = ["outcome"]
        stamped = with_audit(rows, source, ingested_at, environment=environment)
        if when is not None:
            when = F.col(when) if isinstance(when, str) else when
            reason = F.coalesce(reason, F.when(when.isNull(), NO_TIME))
            folders += ["year", "month", "day"]
            stamped = stamped.withColumns({"year": F.date_format(when, "yyyy"), "month": F.date_format(when, "MM"),
                                           "day": F.date_format(when, "yyyy-MM-dd")})
        stamped = stamped.withColumns({"_reject": reason, "outcome": F.when(reason.isNull(), "accepted").otherwise("rejected")})
        if near:
            stamped = stamped.withColumns({"_curve": curve_key(near), "_tie": F.xxhash64(*rows.columns)})
            order = [*folders, "_curve", "_tie"]
            ranged = stamped.repartitionByRange(files, *order) if files else stamped.repartitionByRange(*order)
            ready = ranged.sortWithinPartitions(*order).drop("_curve", "_tie")
        else:
            ready = stamped.hint("rebalance", *[F.col(c) for c in folders])
        seen = Observation()
        observed = ready.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_reject").isNull()).alias("accepted"),
                                 F.count_if(F.col("_reject").isNotNull()).alias("rejected"))
        path = f"{self.root}/{source}/version={version}"
        observed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*folders).parquet(path)
        written = T.StructType([f for f in ready.schema.fields if f.name not in folders]).json()
        return self._switch(source, feed, version, path, folders, seen.get, len(rows.columns), ingested_at, written)

    def _switch(self, source: str, feed: str, version: int, path: str, folders: list[str], seen: dict, columns: int,
                ingested_at: str, schema: str) -> DataFrame:
        """Compare what was seen with what the files say, then make the version the current one."""
        by_month = "year" in folders
        counted = footer_counts(self.spark, path, folders[:3]).collect() if seen["rows"] else []  # a row per month
        written = {o: sum(r.row_count for r in counted if r.outcome == o) for o in ("accepted", "rejected")}
        if written != {o: seen[o] for o in written} or sum(written.values()) != seen["rows"]:
            raise LandingError(f"{source}: {seen} were seen, {written} written; what was there stays")
        out = [(source, r.outcome, feed, str(r.year) if by_month and r.year is not None else None,
                f"{int(r.month):02d}" if by_month and r.month is not None else None, version, r.row_count, columns, r.file_count,
                by_month, ingested_at, schema) for r in counted]
        # an empty feed supersedes what it brought before by nothing
        out = out or [(source, "accepted", feed, None, None, version, 0, columns, 0, by_month, ingested_at, schema)]
        rows = self.spark.createDataFrame(out, CURRENT)
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/_current")  # a row per month, in one file
        return rows


def _schema(written: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(written))


def footer_counts(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """Rows and files per value of the `folders` that a written table is partitioned by.

    No column is read (the scan's schema is empty), so the counts come from the files' footers.
    """
    files = spark.read.option("basePath", path).parquet(path).groupBy(*folders, F.col("_metadata.file_path").alias("file"))
    return files.agg(F.count(F.lit(1)).alias("n")).groupBy(*folders).agg(
        F.sum("n").alias("row_count"), F.count("file").alias("file_count"))
