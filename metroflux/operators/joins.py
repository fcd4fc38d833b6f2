"""Joins against small sides whose size is proven, never counted.

A fact-sized input (trips) must not be shuffled just to meet an hourly
dimension. A side is broadcast here only when a bound on its rows follows from
its definition (hours in the analysis window, say). Every other side is left to
the planner, which compares the side's bytes with
`spark.sql.autoBroadcastJoinThreshold`, and to AQE, which measures them after the
fact and splits skewed keys. Building a plan runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows of a hash relation that every executor may hold, at about `ROW_BYTES` each
MAX_BROADCAST_BYTES = 64 << 20
ROW_BYTES = 512


def bounded_broadcast(df: DataFrame, at_most_rows: int | None = None, row_bytes: int = ROW_BYTES) -> DataFrame:
    """`broadcast(df)` when at most `at_most_rows` rows, known without a job, fit the byte bound; else `df`."""
    if at_most_rows is not None and at_most_rows * row_bytes <= MAX_BROADCAST_BYTES:
        return F.broadcast(df)
    return df
