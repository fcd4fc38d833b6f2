"""Hard-negative mining by threshold joins over an inverted index with suffix-norm bounds.

Task. Every anchor has its best rows of the same label as positives. Per positive, a negative is a row of another
label whose score (integer inner product with the anchor) lies in a window given by the positive's score; the
best few of each window are wanted.

Method. Dimensions are taken in the order of their energy over the table, in groups. A vector's suffix norm at a
group is the norm of what it holds from there on; by Cauchy-Schwarz the product of two suffix norms bounds what
those dimensions can still add. For a threshold t the index of a group of dimensions lists a vector only while its
suffix norm could lift some query of the batch to t by itself; the dimensions behind are covered by the bound and are
left out. Partial scores are accumulated group by group; a candidate goes once its partial score and the
product of the remaining norms stay below t. What is left is scored exactly.

Windows are filled from above: a search starts with a threshold near the top of the windows and is repeated, for
anchors with unfilled windows only, with lower ones, at last at the bottom of the window. So the
result is exact whatever the steps are.

Scale. Vectors lie in shards of bounded size (positives: of one label), whatever share one label holds. Queries travel to the
shards, not the shards to the queries, and stream through the task that holds a shard's index. A task sends
at most the wanted number per window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import Scratch

SHARD = 1 << 21  # components in the vectors of one shard
CELL = 1 << 20  # partial scores held at a time
GROUPS = 8  # groups of dimensions
_EXACT = 2.0 ** 53
NO_THRESHOLD = np.iinfo(np.int64).min


class Index:
    """The vectors of one shard as lists per group of dimensions, in the order of their suffix norms."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.rows, self.labels, self.whole = ids, rows, labels, vectors
        dim = vectors.shape[1]
        self.step = max(1, -(-dim // GROUPS))
        self.starts = list(range(0, dim, self.step))
        self.vectors = vectors.astype(float)
        self.norms = suffix_norms(self.vectors, self.starts)
        self.order = [np.argsort(-self.norms[:, g], kind="stable") for g in range(len(self.starts))]
        self.largest = float(np.abs(self.vectors).max(initial=0))

    def search(self, queries: np.ndarray, t: np.ndarray, allowed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query the places of the vectors whose score is at least `t`, and the scores; `allowed` masks pairs."""
        q = queries.astype(float)
        q_norms = suffix_norms(q, self.starts)
        n = len(self.ids)
        partial = np.zeros((len(q), n))
        alive = allowed.copy()
        done = np.zeros(n, np.int64)  # groups accumulated so far
        slack = 1e-6 + 1e-9 * q_norms[:, 0] * self.norms[:, 0].max(initial=0)
        floor = np.where(t == NO_THRESHOLD, -np.inf, t - slack)
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(q_norms > 0, floor[:, None] / q_norms, np.where(floor[:, None] > 0, np.inf, -np.inf)).min(axis=0)
        for g, start in enumerate(self.starts):
            order = self.order[g]
            listed = order[:np.searchsorted(-self.norms[order, g], -least[g], side="right")]
            if not len(listed):
                break
            listed = listed[alive[:, listed].any(axis=0)]
            if not len(listed):
                break
            stop = start + self.step
            partial[:, listed] += q[:, start:stop] @ self.vectors[listed, start:stop].T
            done[listed] = g + 1
            rest = q_norms[:, g + 1, None] * self.norms[None, listed, g + 1]
            alive[:, listed] &= partial[:, listed] + rest >= floor[:, None]
        alive[:, done == 0] = False  # in no list: the norms alone rule it out
        for i in range(len(q)):
            at = np.flatnonzero(alive[i])
            scores = self.scores(queries[i], at)
            fine = scores >= t[i]
            yield at[fine], scores[fine]

    def scores(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact scores; in float64 while no sum can leave its exact integers, else in whole numbers of any size (beyond 64 bits an error)."""
        if float(np.abs(query).max(initial=0)) * self.largest * max(1, len(query)) < _EXACT:
            return (self.vectors[at] @ query.astype(float)).astype(np.int64)
        return np.array([int(x) for x in self.whole[at].astype(object) @ query.astype(object)], np.int64)


def suffix_norms(vectors: np.ndarray, starts: list[int]) -> np.ndarray:
    """The norm of every vector from each start on, and 0 beyond the last dimension."""
    squares = np.add.reduceat(vectors * vectors, starts, axis=1)
    tails = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([tails, np.zeros((len(vectors), 1))], axis=1))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _shard_join(orders: dict[int, list[int]], answer, names: list[str]):
    """Rows sorted by (shard, kind): the vectors of a shard, then the queries that it gets, which stream through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, waiting, index = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            shards, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shards)], strict=True):
                part = batch.slice(a, b - a)
                if shards[a] != shard:
                    shard, waiting, index = shards[a], [], None
                vectors = _matrix(part.column("w"))
                vectors = vectors[:, orders[vectors.shape[1]]]
                if kinds[a] == 0:
                    waiting.append([*(part.column(c).to_numpy() for c in ("vec_id", "row", "label")), vectors])
                    continue
                if index is None:
                    if not waiting:
                        continue  # a shard without vectors
                    index, waiting = Index(*(np.concatenate(c) for c in zip(*waiting, strict=True))), []
                step = max(1, CELL // len(index.ids))
                for x in range(0, part.num_rows, step):
                    piece = part.slice(x, step)
                    found = list(answer(index, piece, vectors[x:x + step]))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "i" else pa.int64())
                                                          for n, c in zip(names, zip(*found, strict=True), strict=True)], names=names)
    return run


def _best_of_shard(k: int, seed: int = 512):
    """The k best other rows of every query; the threshold is the k-th score among the first vectors of the shard."""
    def answer(index: Index, queries: pa.RecordBatch, vectors: np.ndarray):
        rows = queries.column("row").to_numpy()
        other = index.rows[None, :] != rows[:, None]
        t = np.full(len(rows), NO_THRESHOLD)
        for i, v in enumerate(vectors):
            first = index.scores(v, np.flatnonzero(other[i, :seed]))
            if len(first) >= k:
                t[i] = np.sort(first)[-k]
        for row, (at, scores) in zip(rows.tolist(), index.search(vectors, t, other), strict=True):
            for s, v in _first(index.ids[at], scores, k):
                yield row, v, s
    return answer


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    best = np.lexsort((ids, -scores))[:k]
    return list(zip(scores[best].tolist(), ids[best].tolist(), strict=True))


def _fill_windows(k: int):
    """Per window of every query the k best rows of another label at or above the query's threshold."""
    def answer(index: Index, queries: pa.RecordBatch, vectors: np.ndarray):
        t = queries.column("t").to_numpy()
        other = index.labels[None, :] != queries.column("label").to_numpy()[:, None]
        rows, windows = queries.column("row").to_pylist(), queries.column("windows").to_pylist()
        for row, of_row, (at, scores) in zip(rows, windows, index.search(vectors, t, other), strict=True):
            order = np.lexsort((index.ids[at], -scores))
            ids, ranked = index.ids[at][order], -scores[order]
            for w in of_row:
                a, b = np.searchsorted(ranked, -w["high"]), np.searchsorted(ranked, -w["low"], side="right")
                for s, v in zip(ranked[a:min(b, a + k)].tolist(), ids[a:min(b, a + k)].tolist(), strict=True):
                    yield row, w["i"], v, -s
    return answer


def _energies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        if batch.num_rows:
            for dim in np.unique(np.asarray(batch.column(0).value_lengths())):
                rows = batch.filter(pa.array(np.asarray(batch.column(0).value_lengths()) == dim)).column(0)
                sums[int(dim)] = sums.get(int(dim), 0) + (_matrix(rows).astype(float) ** 2).sum(axis=0)
    for dim, s in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array(s)],
                                         names=["dim", "place", "energy"])


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and w = floor(scale * x); rows with a NULL id or label or a vector that is NULL, empty or not all finite go."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0) & F.coalesce(fine, F.lit(False))
    ).select("vec_id", "label", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("w"))


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256, shard: int = SHARD, steps: tuple[int, ...] = (1, 3, 8)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), the negatives of every anchor and positive.

    `vectors` has vec_id, label and embedding; other columns are not read. Anchors are the rows whose vec_id is divisible by
    `every`; an anchor's positives are its `positives` best other rows of the same label, higher scores first, ties by smaller vec_id. Of the rows of another
    label with low * positive_score <= 100 * negative_score <= high * positive_score the best `negatives` are returned.

    Rows with a NULL id or label, or a NULL or empty vector or one with NULL or non-finite components, take no part. Vectors of different
    lengths do not meet. Rows are told apart by their place, so repeated rows and ids are rows of their own: positives and negatives
    of each other, and anchors each. A negative positive_score leaves no window. An empty table gives no rows.
    `steps`, up to the last, are the parts of a window that the successive thresholds reach down to; they never change the result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = quantised(vectors, scale).select(F.monotonically_increasing_id().alias("row"), "*", F.size("w").alias("dim"))
    rows = scratch.keep(rows, "rows")
    energy = rows.select("w").mapInArrow(_energies, "dim int, place int, energy double").groupBy("dim", "place").agg(F.sum("energy").alias("e"))
    orders: dict[int, list[int]] = {}
    for r in energy.orderBy("dim", F.desc("e"), "place").collect():  # one row per dimension
        orders.setdefault(r.dim, []).append(r.place)

    anchors = rows.where(F.col("vec_id") % every == 0)
    wanted = scratch.keep(_positives(rows, anchors, orders, positives, shard), "positives")
    # integer bounds of every window, exact beyond 64 bits
    bound = lambda x: F.expr(f"cast({x} as bigint)")
    wanted = wanted.where(F.col("score") >= 0).select(
        "row", "i", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        bound(f"(cast(score as decimal(20,0)) * {low} + 99) div 100").alias("low"),
        bound(f"(cast(score as decimal(20,0)) * {high}) div 100").alias("high")).where(F.col("low") <= F.col("high"))
    shards = _shards(rows, ["dim"], shard)
    still, out = scratch.keep(wanted, "windows"), []
    for step in steps:
        reach = F.col("high") - F.floor((F.col("high") - F.col("low")) * step / steps[-1]).cast("long") if step < steps[-1] else F.col("low")
        windows = still.withColumn("t", F.greatest(reach, "low")).groupBy("row").agg(
            F.min("t").alias("t"), F.collect_list(F.struct("i", "low", "high")).alias("windows"))
        queries = anchors.join(windows, "row").join(_shard_numbers(rows, ["dim"], shard), "dim")
        queries = queries.select("*", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("number")).withColumn(
            "shard", F.xxhash64("dim", "number")).select("shard", "row", "vec_id", "label", "w", "t", "windows")
        found = _meet(shards, queries, orders, _fill_windows(negatives), ["row", "i", "vec_id", "score"])
        place = F.row_number().over(Window.partitionBy("row", "i").orderBy(F.desc("score"), "vec_id"))
        best = scratch.keep(found.withColumn("rank", place.cast("int")).where(F.col("rank") <= negatives), "found")
        full = best.groupBy("row", "i").agg(F.max("rank").alias("n"))
        state = still.join(windows.select("row", "t"), "row").join(full, ["row", "i"], "left")
        state = scratch.keep(state.withColumn("closed", (F.coalesce("n", F.lit(0)) >= negatives) | (F.col("t") <= F.col("low"))), "state")
        closed = state.where("closed").select("row", "i", "positive_id", "positive_score")
        out.append(best.join(closed, ["row", "i"]))
        still = state.where("not closed").drop("t", "n", "closed")
        if still.isEmpty():
            break
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    named = result.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                        F.col("score").alias("negative_score"))


def _shard_numbers(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """How many shards each group of rows has: as many as keep a shard at about `size` components."""
    n = F.ceil(F.count(F.lit(1)) * F.max("dim") / size).cast("int")
    return rows.groupBy(*dict.fromkeys(["dim", *by])).agg(n.alias("n_shards"))


def _shards(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    number = F.pmod(F.xxhash64("row"), F.col("n_shards")).cast("int")
    keys = list(dict.fromkeys(["dim", *by]))
    return rows.join(_shard_numbers(rows, by, size), keys).select(
        F.xxhash64(*by, number).alias("shard"), "row", "vec_id", "label", "w")


def _meet(shards: DataFrame, queries: DataFrame, orders, answer, names: list[str]) -> DataFrame:
    extra = [c for c in queries.columns if c not in shards.columns]
    empty = [F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in extra]
    both = shards.select(F.lit(0).alias("kind"), *shards.columns, *empty).unionByName(
        queries.select(F.lit(1).alias("kind"), *queries.columns))
    schema = ", ".join(f"{c} {'int' if c == 'i' else 'long'}" for c in names)
    return both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_shard_join(orders, answer, names), schema)


def _positives(rows: DataFrame, anchors: DataFrame, orders, k: int, size: int) -> DataFrame:
    """(row, i, vec_id, score): the k best other rows of each anchor's label, i from 1."""
    by = ["dim", "label"]
    queries = anchors.join(_shard_numbers(rows, by, size), by).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("number")).select(
        F.xxhash64(*by, "number").alias("shard"), "row", "vec_id", "label", "w")
    found = _meet(_shards(rows, by, size), queries, orders, _best_of_shard(k), ["row", "vec_id", "score"])
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("i", place.cast("int")).where(F.col("i") <= k)
