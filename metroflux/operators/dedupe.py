"""Keep one row per key with a deterministic survivor.

`row_number() over (partition by keys order by ...) = 1` is planned by Spark
as a WindowGroupLimit: a partial limit runs on the map side before the
shuffle, so a key with millions of copies leaves each map task as one row and
a hot group of copies never lands whole on one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, first: list[str | Column] | None = None,
                exclude: list[str] | None = None) -> list[Column]:
    """`first` then every remaining column, ascending, NULLs first.

    Ordering on all columns makes the survivor independent of input order,
    so reruns and different partitionings keep the same row.
    """
    first = list(first or [])
    named = {c for c in first if isinstance(c, str)} | set(exclude or [])
    cols = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in first]
    cols += [F.col(c).asc_nulls_first() for c in df.columns if c not in named]
    return cols


def dedupe(df: DataFrame, keys: list[str | Column], order: list[Column] | None = None,
           rank_col: str = "_rn") -> DataFrame:
    """One row per `keys`; the first row by `order` (default: all other columns) wins."""
    key_names = [k for k in keys if isinstance(k, str)]
    order = order or total_order(df, exclude=key_names)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1)
              .drop(rank_col))

