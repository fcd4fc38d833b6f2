"""What the operators share: tables, written intermediate results, bounded pruning, Arrow text access."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Written intermediate tables of one run, in the folder the cluster shares.

    A table that several steps read is written once and read back, so lineage
    ends there and a lost executor recomputes from the written table.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._n = 0

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, modulo 5, is 0 (a NULL id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


# --- pruning by a bitmap of fixed size ------------------------------------------------

BITMAP_WORDS = 1 << 17  # 1 MB of bits; the broadcast has at most this many rows of two numbers


def id_bitmap(ids: DataFrame, col: str) -> DataFrame:
    """A bitmap of BITMAP_WORDS 64-bit words over hashed ids: at most so many rows however many ids there are."""
    words = BITMAP_WORDS
    h = F.xxhash64(F.col(col))
    return ids.where(F.col(col).isNotNull()).select(
        F.pmod(h, F.lit(words)).cast("int").alias("__word"),
        F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int").alias("__bit"),
    ).groupBy("__word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__bit"))).alias("__bits"))


def may_hold(df: DataFrame, col: str, bitmap: DataFrame, flag: str) -> DataFrame:
    """`df` with a boolean column: False where the id is certainly in no row of the bitmap."""
    words = BITMAP_WORDS
    h = F.xxhash64(F.col(col))
    bit = F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int")
    hit = F.call_function("shiftright", F.col("__bits"), bit).bitwiseAND(F.lit(1)) == 1
    joined = df.join(F.broadcast(bitmap), F.pmod(h, F.lit(words)).cast("int") == bitmap["__word"], "left")
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__word", "__bits")


def prune_by_ids(df: DataFrame, col: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of `df` that may have an id in `ids`; rows that cannot are dropped before any shuffle.

    With very many ids the bitmap fills up and lets more rows through; the exact
    join that must follow keeps the result right.
    """
    return may_hold(df, col, id_bitmap(ids, id_col), "__may").where("__may").drop("__may")


# --- Python workers ------------------------------------------------------------------

def give_back(*caches: Callable[[], None]) -> None:
    """Clear the caches and return freed memory to the system."""
    for clear in caches:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(*caches: Callable[[], None]):
    """Decorator of a batch function: at the end of its task the caches are cleared and freed memory goes back.

    Python workers outlive their tasks and serve the stages that follow, so what a stage leaves adds up.
    """
    def wrap(run):
        @functools.wraps(run)
        def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            try:
                yield from run(batches)
            finally:
                give_back(*caches)
        return inner
    return wrap


# --- Arrow text -------------------------------------------------------------------------

def text_slices(column, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about `limit` bytes each (a longer text is a range of its own)."""
    n = len(column)
    if not n:
        return
    _, offsets = text_buffer(column)
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the int64 offsets of its rows; NULL reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]
