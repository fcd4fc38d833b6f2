"""Exact top-k inner-product search with block-at-a-time pruning.

Method. The candidates lie in blocks of consecutive documents (a forward
index: one row of integer term weights per document) with the largest and the
smallest weight of each term. For a query, the sum over terms of weight times
that extreme bounds every score in the block. Blocks are taken in order of
their bounds and scored whole; once a bound falls below the k-th best score,
the rest cannot matter.

Queries and blocks meet in cells of bounded size (at most `cell_queries`
queries and `cell_blocks` blocks), spread over the cluster. A first pass scores
only the most promising block of every query, so that every cell starts with
a k-th score. Results are exact; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import Scratch

BLOCK = "block long, ids array<long>, rows binary, high binary, low binary"
FOUND = "query_id long, vec_id long, score long"


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.int64).reshape(-1, dim)


def _pack(key: str, ids: np.ndarray, rows: np.ndarray, number: int) -> dict:
    return {key: number, "ids": ids, "rows": rows.tobytes(), "high": rows.max(axis=0).tobytes(), "low": rows.min(axis=0).tobytes()}


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and the integer weights floor(scale * x); vectors that are NULL, empty or hold NULL, NaN or infinity go."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & (F.size("x") > 0) & F.coalesce(fine, F.lit(False))
    ).select("vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("w"))


def _block_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def out(part):
            ids = np.concatenate([p[0] for p in part])
            rows = np.concatenate([p[1] for p in part])
            recs = [_pack("block", ids[a:a + size], rows[a:a + size], int(ids[a])) for a in range(0, len(ids), size)]
            return pa.RecordBatch.from_pylist(recs, schema=pa.schema(
                [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("rows", pa.binary()), ("high", pa.binary()), ("low", pa.binary())]))

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            waiting.append((ids, rows))
            held += len(ids)
            if held >= 16 * size:
                yield out(waiting)
                waiting, held = [], 0
        if waiting:
            yield out(waiting)
    return run


def blocks_of(weights: DataFrame, size: int, dim: int, parts: int) -> DataFrame:
    """Consecutive ids in rows of at most `size` vectors, with the extremes of every term."""
    ranged = weights.where(F.size("w") == dim).repartitionByRange(parts, "vec_id").sortWithinPartitions("vec_id")
    return ranged.mapInArrow(_block_rows(size), BLOCK)


def _bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Query by block: the summed maxima of every term's contribution (exact in float64 below 2 ** 53)."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _seed_blocks(k: int, dim: int):
    """The most promising blocks of every query among the summaries of one cell."""
    def run(key, queries: pd.DataFrame, summaries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(summaries):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "block": pd.Series(dtype="int64"), "bound": pd.Series(dtype="float64")})
        high = np.vstack([_matrix(x, dim) for x in summaries["high"]]).astype(float)
        low = np.vstack([_matrix(x, dim) for x in summaries["low"]]).astype(float)
        ids = np.concatenate([np.asarray(x) for x in queries["ids"]])
        q = np.vstack([_matrix(x, dim) for x in queries["rows"]]).astype(float)
        bound = _bounds(q, high, low)
        at = bound.argmax(axis=1)
        return pd.DataFrame({"query_id": ids, "block": summaries["block"].to_numpy()[at], "bound": bound[np.arange(len(ids)), at]})
    return run


def _score_cell(k: int, dim: int):
    """Top k of one cell for each of its queries, block by block in order of the bounds."""
    def run(key, queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        got_q, got_v, got_s = [], [], []
        if len(queries) and len(blocks):
            high = np.vstack([_matrix(x, dim) for x in blocks["high"]]).astype(float)
            low = np.vstack([_matrix(x, dim) for x in blocks["low"]]).astype(float)
            ids = [np.asarray(x, np.int64) for x in blocks["ids"]]
            rows = [_matrix(x, dim).astype(float) for x in blocks["rows"]]
            q_ids = queries["query_id"].to_numpy()
            q = np.vstack([_matrix(x, dim) for x in queries["w"]]).astype(float)
            kth = queries["kth"].to_numpy().astype(float)
            bound = _bounds(q, high, low)
            order = np.argsort(-bound, axis=1, kind="stable")
            best_v = [np.zeros(0, np.int64)] * len(q_ids)
            best_s = [np.zeros(0)] * len(q_ids)
            live = np.arange(len(q_ids))
            for step in range(len(ids)):
                # a block whose bound equals the k-th score may still hold a smaller id
                live = live[bound[live, order[live, step]] >= kth[live]]
                if not len(live):
                    break
                for b in np.unique(order[live, step]):
                    here = live[order[live, step] == b]
                    scores = q[here] @ rows[b].T
                    for i, s in zip(here, scores, strict=True):
                        fine = (s >= kth[i]) & (ids[b] != q_ids[i])
                        v, s = np.concatenate([best_v[i], ids[b][fine]]), np.concatenate([best_s[i], s[fine]])
                        top = _best(v, s, k)
                        best_v[i], best_s[i] = v[top], s[top]
                        if len(top) == k:
                            kth[i] = max(kth[i], best_s[i][-1])
            for i, v, s in zip(q_ids, best_v, best_s, strict=True):
                got_q.append(np.full(len(v), i))
                got_v.append(v)
                got_s.append(s)
        cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        return pd.DataFrame({"query_id": cat(got_q), "vec_id": cat(got_v), "score": cat(got_s)})
    return run


def _seed_scores(k: int, dim: int):
    """The k-th best score of each query within its seed block (no bound with fewer than k candidates)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            kth = []
            for q_id, w, ids, rows in zip(f["query_id"], f["w"], f["ids"], f["rows"], strict=True):
                s = _matrix(rows, dim).astype(float) @ _matrix(w, dim)[0].astype(float)
                s = np.sort(s[np.asarray(ids) != q_id])[::-1]
                kth.append(s[k - 1] if len(s) >= k else -np.inf)
            yield pd.DataFrame({"query_id": f["query_id"], "kth": np.array(kth, float)})
    return run


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, block: int = 256,
           cell_queries: int = 1024, cell_blocks: int = 64) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) for every query row, vec_id divisible by `every`, against all rows.

    Vectors that are NULL or empty or hold NULL or non-finite components take no part. Vectors of
    different lengths are never compared: each length is searched by itself. Repeated
    ids are candidates as often as they occur; a query never finds rows of its own id, and a
    repeated query row is one query per distinct vector. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    weights = scratch.keep(quantised(vectors, scale), "weights")
    sizes = weights.groupBy(F.size("w").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()
    found = [_search_dim(scratch, weights, r.dim, r.n, k, every, block, cell_queries, cell_blocks) for r in sorted(sizes)]
    out = spark.createDataFrame([], FOUND) if not found else found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    from pyspark.sql import Window
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_dim(scratch: Scratch, weights: DataFrame, dim: int, n: int, k: int, every: int, block: int,
                cell_queries: int, cell_blocks: int) -> DataFrame:
    spark = weights.sparkSession
    n_blocks = -(-n // block)
    shards = max(1, -(-n_blocks // cell_blocks))
    parts = max(1, min(n_blocks, 2 * shards))
    blocks = scratch.keep(blocks_of(weights, block, dim, parts), "blocks").withColumn(
        "shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int"))
    pack = F.udf(lambda w: np.asarray(w, np.int64).tobytes(), "binary")
    q = weights.where((F.size("w") == dim) & (F.col("vec_id") % every == 0)).distinct()
    q = q.select(F.col("vec_id").alias("query_id"), pack("w").alias("w"))
    groups = max(1, -(-n // (every * cell_queries)))
    q = scratch.keep(q.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")), "queries")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    all_groups = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    # 1. the block with the best bound, over the block summaries only
    cell_q = q.select(F.array("query_id").alias("ids"), F.col("w").alias("rows"), "group").withColumn("shard", everywhere)
    cell_s = blocks.select("block", "high", "low", "shard").withColumn("group", all_groups)
    seeds = (cell_q.groupBy("group", "shard").cogroup(cell_s.groupBy("group", "shard"))
             .applyInPandas(_seed_blocks(k, dim), "query_id long, block long, bound double"))
    seeds = seeds.groupBy("query_id").agg(F.max_by("block", F.struct("bound", "block")).alias("block"))
    # 2. the k-th score within it
    kth = (q.join(seeds, "query_id").join(blocks.select("block", "ids", "rows"), "block")
           .select("query_id", "w", "ids", "rows").mapInPandas(_seed_scores(k, dim), "query_id long, kth double"))
    kth = kth.groupBy("query_id").agg(F.min("kth").alias("kth"))
    # 3. every cell, pruned by it
    ready = scratch.keep(q.join(kth, "query_id"), "ready").withColumn("shard", everywhere)
    full = blocks.withColumn("group", all_groups)
    return (ready.groupBy("group", "shard").cogroup(full.groupBy("group", "shard"))
            .applyInPandas(_score_cell(k, dim), FOUND))
