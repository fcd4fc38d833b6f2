"""Benchmark decontamination: edit-tolerant search of benchmark items in whole texts.

Words are compared without case and punctuation. A text is contaminated by an item of n words
if some stretch of it is within K word edits of the item, K = n // 5 (less for
items so short that three-word pieces would not survive K edits).

Method. The CGK embedding walks over a window: at step j it writes the current word
and moves on if a random bit of (word, j) says so; few edits between two windows leave
few differing steps, so edit distance becomes Hamming distance. A key is a hash of some
sampled steps (bit sampling); `repeats` walks with new randomness give as many keys, and a
window that shares a key with an item is a candidate. Candidates are verified by the exact edit distance.

Sampled keys may all miss, and walks start in an item's head only (its first K + 4 pieces), so segments complete
them: an item is cut into K + 1 segments of three to five words, K edits touch at most K of them, and one
stands unchanged in every stretch within K edits. A segment's hash is a key too, so no match is lost, wherever its edits are.

Item lengths fall into classes, and every class has its own walks. K edits destroy at most 3 K of an item's n - 2
three-word pieces, so a window of the class' greatest length with fewer known pieces is out. Places of keys
that stand close together share one stretch of text, wide enough on both sides for any item of the class.

What every task gets are four bitmaps of fixed size (pieces, head pieces, segments and keys of all items); items
themselves meet candidates in a join, so a large benchmark is never broadcast whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import BITMAP_WORDS, Scratch, id_bitmap, may_hold, text_buffer, text_slices, tidy
from metroflux.llm.words import U, mix, plain, word_hashes, word_spans

PIECE = 3
RATIO = 1.15
SAMPLED = 3
HEAD = 4
SEGMENT_SIZES = (3, 4, 5)  # of n words cut into K + 1, for any n
STRETCH = 4


def most_edits(n):
    """K of an item of n words: a fifth, but never so many that no three-word piece must survive."""
    return np.minimum(n // 5, np.maximum(0, (n - PIECE) // PIECE))


def class_of(n):
    return np.floor(np.log(np.maximum(n, PIECE)) / np.log(RATIO) + 1e-9).astype(np.int64)


def _bit_at(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (bitmap[(h % U(BITMAP_WORDS)).astype(np.int64)] >> ((h >> U(40)) % U(64))) & U(1) == 1


def piece_hashes(words: np.ndarray) -> np.ndarray:
    if len(words) < PIECE:
        return words[:0]
    return mix(words[:-2] * U(3) + mix(words[1:-1]) * U(5) + mix(mix(words[2:]) + U(9)))


def segment_hashes(words: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size` words from every place."""
    out = np.full(len(places), size, U)
    for j in range(size):
        out = mix(out * U(31) + words[places + j])
    return out


def item_segments(words: np.ndarray) -> np.ndarray:
    """Hashes of the K + 1 segments of an item."""
    parts = int(most_edits(len(words))) + 1
    cuts = np.arange(parts + 1) * len(words) // parts
    sizes = np.diff(cuts)
    return np.concatenate([segment_hashes(words, cuts[:-1][sizes == size], size) for size in SEGMENT_SIZES])


def walk_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, number: int, repeats: int) -> np.ndarray:
    """Keys (windows x repeats) of the windows [start, end) of a word array, in the walks of class `number`."""
    steps = max(SAMPLED, int(1.5 * RATIO ** number))
    keys = np.zeros((len(starts), repeats), U)
    for r in range(repeats):
        rng = np.random.default_rng((number, r))
        sampled = set(rng.choice(steps, SAMPLED, replace=False).tolist())
        salts = rng.integers(1, 2**62, steps // 64 + 2, dtype=np.int64).astype(U)
        at, key = starts.copy(), np.full(len(starts), salts[-1], U)
        for j in range(max(sampled) + 1):
            word = np.where(at < ends, words[np.minimum(at, len(words) - 1)], U(0))
            if j in sampled:
                key = mix(key * U(31) + word)
            at = at + ((mix(word ^ salts[j // 64]) >> U(j % 64)) & U(1)).astype(np.int64)
        keys[:, r] = mix(key + U(number * 1000 + r))
    return keys


def _words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_buffer(column)
    starts, ends, firsts = word_spans(data, offsets, plain())
    return data, offsets, starts, ends, firsts, word_hashes(data, starts, ends)


def _item_batches(repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            if batch.num_rows:
                _, _, _, _, firsts, words = _words(batch.column(1))
                for i, (a, b) in enumerate(zip(firsts, firsts[1:], strict=False)):
                    w, n = words[a:b], int(b - a)
                    if n < PIECE:
                        continue
                    number = int(class_of(n))
                    head = np.arange(min(int(most_edits(n)) + HEAD, n - PIECE + 1))
                    keys = np.unique(walk_keys(w, head, np.full(len(head), n), number, repeats))
                    parts = np.unique(item_segments(w))
                    rows.append({"item_id": batch.column(0)[i].as_py(), "n": n, "class": number, "item": w.tobytes(),
                                 "keys": keys.astype(np.int64).tolist(), "pieces": piece_hashes(w).astype(np.int64).tolist(),
                                 "heads": len(head), "segments": parts.astype(np.int64).tolist()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("item_id", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("item", pa.binary()),
                 ("keys", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int64())), ("heads", pa.int64()),
                 ("segments", pa.list_(pa.int64()))]))
    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap of a column `h` of hashes, at most BITMAP_WORDS rows to the driver."""
    word = F.expr(f"(h & {BITMAP_WORDS - 1})")
    bit = F.call_function("shiftrightunsigned", F.col("h"), F.lit(40)).bitwiseAND(F.lit(63)).cast("int")
    rows = hashes.select(word.alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b")).groupBy(
        "w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(BITMAP_WORDS, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out.view(U)


def _segments_at(words: np.ndarray, places: np.ndarray, stops: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into `places` where a known segment may begin that ends by `stops`, and the segments' hashes."""
    index, keys = [], []
    for size in SEGMENT_SIZES:
        i = np.flatnonzero(places + size <= stops)
        h = segment_hashes(words, places[i], size)
        fine = _bit_at(known, h)
        index.append(i[fine])
        keys.append(h[fine])
    return np.concatenate(index), np.concatenate(keys)


def _stretches(places: np.ndarray, docs: np.ndarray, keys: np.ndarray, longest: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Places that share a stretch, as (text, first place, last place, distinct keys); a stretch has a bounded length."""
    order = np.argsort(places, kind="stable")
    places, docs, keys = places[order], docs[order], keys[order]
    begin = 0
    for i in range(1, len(places) + 1):
        if i == len(places) or docs[i] != docs[begin] or places[i] > places[i - 1] + longest or places[i] > places[begin] + STRETCH * longest:
            yield int(docs[begin]), int(places[begin]), int(places[i - 1]), np.unique(keys[begin:i])
            begin = i


def _window_batches(shared, repeats: int):
    """Candidate stretches of every text, each with its words and those keys that some item may have."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("class", pa.int64()), ("begin", pa.int64()),
                        ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("window", pa.binary()),
                        ("keys", pa.list_(pa.int64()))])

    @tidy()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, heads, segments, known_keys, classes = shared.value
        for batch in batches:
            for a, b in text_slices(batch.column(2)):
                data, offsets, starts, ends, firsts, words = _words(batch.column(2).slice(a, b - a))
                found = piece_hashes(words)
                if not len(found):
                    continue
                at = np.flatnonzero(_bit_at(pieces, found))
                in_doc = np.searchsorted(firsts, at, side="right") - 1
                fine = at + PIECE <= firsts[in_doc + 1]
                at, in_doc = at[fine], in_doc[fine]
                if not len(at):
                    continue
                from_head = _bit_at(heads, found[at])
                cut, cut_keys = _segments_at(words, at, firsts[in_doc + 1], segments)
                chars = None
                rows = []
                for number, least, longest in classes:
                    stop = np.minimum(at + longest, firsts[in_doc + 1])
                    ok = np.searchsorted(at, stop - PIECE, side="right") - np.arange(len(at)) >= least
                    # some window that begins with a known piece and reaches over the segment must hold enough
                    total = np.concatenate([[0], np.cumsum(ok)])
                    earliest = np.searchsorted(at, np.maximum(at[cut] - longest + 1, firsts[in_doc[cut]]))
                    held = total[cut + 1] > total[earliest]
                    places, keys = [at[cut[held]]], [cut_keys[held]]
                    walked = np.flatnonzero(ok & from_head)
                    for c in range(0, len(walked), 65536):
                        w = walked[c:c + 65536]
                        some = walk_keys(words, at[w], stop[w], number, repeats)
                        i, r = np.nonzero(_bit_at(known_keys, some))
                        places.append(at[w[i]])
                        keys.append(some[i, r])
                    places, keys = np.concatenate(places), np.concatenate(keys)
                    docs = np.searchsorted(firsts, places, side="right") - 1
                    for d, first, last, mine in _stretches(places, docs, keys, longest):
                        if chars is None:
                            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                        base, left, right = chars[offsets[d]], max(first - longest, int(firsts[d])), min(last + longest, int(firsts[d + 1]))
                        rows.append({"row": batch.column(0)[a + d].as_py(), "doc_id": batch.column(1)[a + d].as_py(),
                                     "class": number, "begin": left - int(firsts[d]), "starts": chars[starts[left:right]] - base,
                                     "ends": chars[ends[left:right]] - base, "window": words[left:right].tobytes(),
                                     "keys": mine.astype(np.int64)})
                        if len(rows) >= 500:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def best_end(item: np.ndarray, window: np.ndarray, free_start: bool = False) -> tuple[int, int]:
    """Least word edit distance of the item to a prefix of the window, and the length of that prefix.

    With `free_start`, of all stretches of the window instead, and where the best one ends.
    """
    line = np.zeros(len(window) + 1, np.int64) if free_start else np.arange(len(window) + 1)
    places = np.arange(len(window) + 1)
    for i, w in enumerate(item):
        new = np.empty_like(line)
        new[0] = i + 1
        new[1:] = np.minimum(line[:-1] + (window != w), line[1:] + 1)
        # insertions run along the line: a minimum of (value - place) carried to the right
        line = np.minimum.accumulate(new - places) + places
    at = int(np.argmin(line))
    return int(line[at]), at


@tidy()
def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()),
                        ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        rows = []
        # row by row, places where they lie: as Python numbers those of a batch take many times its size
        for row, doc_id, starts, ends, window, item_id, item in zip(*batch.columns, strict=True):
            item, window = np.frombuffer(item.as_buffer(), U), np.frombuffer(window.as_buffer(), U)
            distance, end = best_end(item, window, free_start=True)
            if distance <= most_edits(len(item)) and end:
                _, size = best_end(item[::-1], window[:end][::-1])
                if size:
                    rows.append({"row": row.as_py(), "doc_id": doc_id.as_py(), "item_id": item_id.as_py(), "distance": distance,
                                 "start": starts[end - size].as_py(), "end": ends[end - 1].as_py()})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, repeats: int = 12) -> DataFrame:
    """(row, doc_id, item_id, distance, start, end): the best stretch of every row of `docs` for every item it holds.

    start and end are character offsets, distance counts word edits. `row` is a number of the row given here.
    NULL, empty and blank texts hold nothing. Items that are NULL or have fewer than three words are no
    passages and match nothing; an item of 3 to 5 words must match exactly. Repeated rows are rows of their own;
    repeated items give one result per (row, item_id). An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).distinct()
    items = scratch.keep(items.mapInArrow(
        _item_batches(repeats), "item_id long, n long, class long, item binary, keys array<long>, pieces array<long>, heads long, segments array<long>"), "items")
    # every class with its weakest demand: known pieces that a window must hold, and the longest window
    n = F.col("n")
    edits = F.least(F.floor(n / 5), F.floor((n - PIECE) / PIECE))
    classes = items.groupBy("class").agg(F.min(n - PIECE + 1 - PIECE * edits).alias("least"), F.max(n + edits).alias("longest")).orderBy("class").collect()
    pieces = _bitmap(items.select(F.explode("pieces").alias("h")))
    heads = _bitmap(items.select(F.explode(F.slice("pieces", F.lit(1), F.col("heads").cast("int"))).alias("h")))
    segments = _bitmap(items.select(F.explode("segments").alias("h")))
    known_keys = _bitmap(items.select(F.explode("keys").alias("h")))
    shared = spark.sparkContext.broadcast((pieces, heads, segments, known_keys, [(r["class"], r.least, r.longest) for r in classes]))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    windows = rows.mapInArrow(_window_batches(shared, repeats),
                              "row long, doc_id long, class long, begin long, starts array<long>, ends array<long>, window binary, keys array<long>")
    asked = windows.withColumn("key", F.explode("keys")).drop("keys")
    offered = items.select(F.explode(F.concat("keys", "segments")).alias("key"), "item_id", "class", "item")
    # keys that agree several times ask for one verification
    pairs = asked.join(offered, ["key", "class"]).dropDuplicates(["row", "class", "begin", "item_id", "item"]).select(
        "row", "doc_id", "starts", "ends", "window", "item_id", "item")
    found = pairs.mapInArrow(_verified, "row long, doc_id long, item_id long, distance int, start long, end long")
    best = found.groupBy("row", "doc_id", "item_id").agg(F.min(F.struct("distance", "start", "end")).alias("b"))
    return best.select("row", "doc_id", "item_id", "b.distance", "b.start", "b.end")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, repeats: int = 12) -> DataFrame:
    """The rows of `docs` that hold no benchmark item; all columns stay."""
    names = docs.columns
    data = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("d"))
    scratch = Scratch(docs.sparkSession, "decontaminated")
    bad = scratch.keep(contaminated(docs, benchmark, repeats).select("row").distinct(), "bad")
    marked = may_hold(data, "row", id_bitmap(bad, "row"), "touched")
    clean = marked.where(~F.col("touched")).select("d.*")
    return clean.unionByName(marked.where("touched").join(bad, "row", "left_anti").select("d.*"))
