"""Jaccard self-join of texts on word shingles through parity sketches.

Sets. A text's set is its distinct 5-word shingles (64-bit hashes; see
`words.shingles`). Texts with equal sets are one node; a node is named by a
64-bit hash of its set.

Sketches. A set is hashed into P parts, and every shingle is XORed into the
word of its part, so each shingle in which two sets differ changes one word at
most: the number of differing words never exceeds the symmetric difference.

Size bands. Sizes are cut into bands. If the smaller of two linked sets lies in a
band, their symmetric difference is at most d, a constant of the band. A set
enters the space of its own band and of every lower band that a partner can lie
in. With more than d parts in use, one part in use must agree (pigeonhole), so
equal (band, part, word) keys bring every linked pair together. A set that uses d
parts or fewer enters a further space with another hash, where two such sets can meet (after SPACES of them, its empty parts).

Groups. Under one key, sets are not paired with one another. Every set is a candidate
with the smallest of its key. First each set is verified against the one of these that it shares
the most keys with; then against the others, unless both are in one component by now.
Where a key still holds different components, only pairs across them are compared, in cells of
bounded size, by a wider one-bit-per-shingle parity sketch whose Hamming distance
is also bounded by the symmetric difference; pairs are compared by one that grows with the sets, before these are moved. Of what passes, a cell first gives a spanning forest of its components (no more
rows than it has members), which is verified on the sets and joins nearly all; a second forest and
last every pair that is still open follow.
So no link between different components is lost, copies cost one node, and a large
group of near copies collapses after the first round.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import Scratch, id_bitmap, may_hold, prune_by_ids, text_buffer, text_slices, tidy
from metroflux.llm.components import components
from metroflux.llm.words import U, mix, shingles, word_hashes, word_spans

BAND = 1.4
SKETCH_BITS = 2048
SMALL = 600  # shingles up to which a quarter of the bits tells unlike sets apart; beyond four times as many, pairs have a sketch with more bits
CELL = 512
SPACES = 6  # hashes that short sets try before they enter empty parts, whose keys are constants of the band


@lru_cache(maxsize=4)
def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest size, largest symmetric difference d and number of parts of every band."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, int(low[-1] * BAND)))
    low = np.array(low)
    d = (low[1:] - 1) * (100 - percent) // percent
    parts = []
    for s, most in zip(low[:-1].tolist(), d.tolist(), strict=True):
        p = most + 1
        while most and p * (1 - (1 - 1 / p) ** s) < most + 1 + most ** 0.5 / 2:
            p = p + max(1, p // 64)
        parts.append(p)
    return low[:-1], d, np.array(parts)


def node_of(s: np.ndarray) -> int:
    """Name of a set: equal sets have equal names."""
    with np.errstate(over="ignore"):
        return int(mix(mix(s ^ U(0x5851F42D4C957F2D)).sum(keepdims=True, dtype=U) + U(len(s)))[0].astype(np.int64))


def _sets(column) -> list[np.ndarray]:
    data, offsets = text_buffer(column)
    starts, ends, firsts = word_spans(data, offsets)
    return shingles(word_hashes(data, starts, ends), firsts, 5)


@tidy()
def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes, bits, wide = [], [], [], []
        for a, b in text_slices(batch.column(2)):
            for s in _sets(batch.column(2).slice(a, b - a)):
                sizes.append(len(s))
                nodes.append(node_of(s))
                bits.append(bit_sketch(s))
                wide.append(wide_sketch(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary()),
             pa.array(wide, pa.binary())],
            names=["row", "doc_id", "n", "node", "bits", "wide"])


def part_keys(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all parts that the sets enter, and the index of the set of each key.

    A set that uses too few parts of a space enters one with another hash besides; two linked sets that
    are both short meet in the first space in which one of them is not.
    """
    low, most, parts = bands(percent)
    sizes = np.array([len(s) for s in sets])
    own = np.searchsorted(low, sizes, side="right") - 1
    lowest = np.searchsorted(low, -(-sizes * percent // 100), side="right") - 1
    who = np.repeat(np.arange(len(sets)), own - lowest + 1)
    band = np.concatenate([np.arange(a, b + 1) for a, b in zip(lowest, own, strict=True)])
    value = [mix(s + U(0xD6E8FEB86659FD93)) for s in sets]
    keys, owners = [], []
    for space in range(SPACES):
        n_parts = parts[band]
        base = np.concatenate([[0], np.cumsum(n_parts)])
        sketch, used = np.zeros(base[-1], U), np.zeros(base[-1], bool)
        spread = {i: sets[i] >> U(20) if space == 0 else mix(sets[i] + U(space)) for i in set(who.tolist())}
        at = np.concatenate([b + spread[i] % U(p) for i, b, p in zip(who.tolist(), base[:-1].astype(U), n_parts, strict=True)]).astype(np.int64)
        np.bitwise_xor.at(sketch, at, np.concatenate([value[i] for i in who]))
        used[at] = True
        few = np.add.reduceat(used, base[:-1], dtype=np.int64) <= most[band]
        entry = np.repeat(np.arange(len(who)), n_parts)
        part = np.arange(base[-1]) - base[entry]
        keep = used | few[entry] if space == SPACES - 1 else used  # in the last one short sets enter their empty parts
        entry, part = entry[keep], part[keep]
        place = mix(band[entry].astype(U) * U(0x100000001B3) + part.astype(U) * U(0x9E3779B97F4A7C15) + U(1) + U(space << 50))
        keys.append(mix(sketch[keep] ^ place).astype(np.int64))
        owners.append(who[entry])
        who, band = who[few], band[few]
        if not len(who):
            break
    return np.concatenate(keys), np.concatenate(owners)


def _keys(percent: int):
    @tidy()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task enter once
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                sets, nodes = [], []
                for s in _sets(batch.column(0).slice(a, b - a)):
                    if len(s) and (node := node_of(s)) not in seen:
                        seen.add(node)
                        sets.append(s)
                        nodes.append(node)
                if sets:
                    keys, who = part_keys(sets, percent)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.array(nodes, np.int64)[who])], names=["key", "node"])
    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and node: every node but the first of its key, with that first one."""
    last_key = last_node = centre = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = (batch.column(i).to_numpy() for i in (0, 1))
        first = np.empty(len(key), bool)
        first[0] = last_key is None or key[0] != last_key
        first[1:] = key[1:] != key[:-1]
        fresh = np.empty(len(key), bool)
        fresh[0] = first[0] or node[0] != last_node
        fresh[1:] = first[1:] | (node[1:] != node[:-1])
        head = np.where(first, np.arange(len(key)), -1)
        head = np.maximum.accumulate(head)
        centres = np.where(head >= 0, node[np.maximum(head, 0)], 0 if centre is None else centre)
        out = fresh & ~first
        last_key, last_node, centre = key[-1], node[-1], centres[-1]
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(node[out]), pa.array(centres[out])],
                                             names=["key", "node", "centre"])


def bit_sketch(s: np.ndarray, n_bits: int = SKETCH_BITS) -> bytes:
    """One bit per shingle, XORed: the Hamming distance of two sketches is at most the symmetric difference.

    Sets of up to SMALL shingles have the sketch folded in four (quarters XORed), which keeps that bound.
    """
    bits = np.bincount((mix(s ^ U(0xA0761D6478BD642F)) % U(n_bits)).astype(np.int64), minlength=n_bits) & 1
    whole = np.packbits(bits.astype(np.uint8)).view(U)
    return (fold(whole) if len(s) <= SMALL else whole).tobytes()


def wide_sketch(s: np.ndarray) -> bytes | None:
    """For a set of more than 4 * SMALL shingles, whose `bit_sketch` is too full to tell it from others, one of four
    times as many bits for every four times the size; folded as often, it is the other one."""
    n_bits = SKETCH_BITS
    while len(s) * SKETCH_BITS > 4 * SMALL * n_bits:
        n_bits *= 4
    return bit_sketch(s, n_bits) if n_bits > SKETCH_BITS else None


def fold(sketch: np.ndarray) -> np.ndarray:
    """A sketch of a quarter of the bits."""
    return np.bitwise_xor.reduce(sketch.reshape(4, -1), axis=0)


def _sketches(*columns: list[bytes]) -> list[np.ndarray]:
    """Columns of sketches as matrices of one width, the least among them: wider ones are folded to it."""
    while len(widths := {len(x) for c in columns for x in c}) > 1:
        columns = [[x if len(x) == min(widths) else fold(np.frombuffer(x, U)).tobytes() for x in c] for c in columns]
    return [np.frombuffer(b"".join(c), U).reshape(len(c), -1) for c in columns]


@tidy()
def _wanted_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        for a, b in text_slices(batch.column(0)):
            rows = []
            for s in _sets(batch.column(0).slice(a, b - a)):
                if len(s) and (node := node_of(s)) not in seen:
                    seen.add(node)
                    rows.append((node, s.tobytes()))
            if rows:
                nodes, raw = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(raw, pa.binary())], names=["node", "members"])


def _linked(percent: int):
    @tidy()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                same = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                fine[i] = 100 * same >= percent * (len(x) + len(y) - same)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fine)), batch.column(1).filter(pa.array(fine))],
                                             names=["a", "b"])
    return run


def _plausible(percent: int):
    """The pairs whose bit sketches do not rule the similarity out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = [batch.column(i).to_numpy() for i in (2, 3)]
                left, right = (batch.column(i).to_pylist() for i in (4, 5))
                far = np.zeros(batch.num_rows, np.int64)
                short = np.array([min(len(u), len(v)) for u, v in zip(left, right, strict=True)])
                for width in np.unique(short):  # a pair with a folded sketch is compared folded
                    at = np.flatnonzero(short == width)
                    x, y = _sketches([left[i] for i in at], [right[i] for i in at])
                    far[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                fine = pa.array(far <= (n[0] + n[1]) * (100 - percent) // (100 + percent))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(fine), batch.column(1).filter(fine)], names=["a", "b"])
    return run


class _Texts:
    """The texts behind the nodes: sketches are at hand, sets are made from the texts when pairs need them."""

    def __init__(self, docs: DataFrame, info: DataFrame, nodes: DataFrame, scratch: Scratch):
        first = F.min(F.struct("row", "n", "bits", "wide")).alias("first")
        known = info.where(F.col("n") > 0).join(nodes, "node", "left_semi").groupBy("node").agg(first)
        self.sketches = scratch.keep(known.select("node", "first.row", "first.n", "first.bits", "first.wide"), "sketches")
        self._rows = docs.select(F.monotonically_increasing_id().alias("row"), "text")

    def sets(self, pairs: DataFrame) -> DataFrame:
        """(node, members) of every node in `pairs`, perhaps of a few others; one text per node is read."""
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        rows = self.sketches.select("node", "row").join(ends, "node", "left_semi")
        texts = prune_by_ids(self._rows, "row", rows, "row").select("text")
        return texts.mapInArrow(_wanted_sets, "node long, members binary").dropDuplicates(["node"])


def verify(pairs: DataFrame, texts: _Texts, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity; sets are made and moved only for pairs that pass the bit sketches."""
    of = lambda side, n, bits: texts.sketches.select(F.col("node").alias(side), F.col("n").alias(n), F.coalesce("wide", "bits").alias(bits))
    fits = 100 * F.least("m", "n") >= percent * F.greatest("m", "n")  # sizes too far apart cannot link
    sizes = lambda side, n: texts.sketches.select(F.col("node").alias(side), F.col("n").alias(n))
    near = pairs.join(sizes("a", "m"), "a").join(sizes("b", "n"), "b").where(fits).select("a", "b")
    close = near.join(of("a", "m", "x"), "a").join(of("b", "n", "y"), "b").select("a", "b", "m", "n", "x", "y")
    pairs = scratch.keep(close.mapInArrow(_plausible(percent), "a long, b long"), "plausible")
    sets = texts.sets(pairs)
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_linked(percent), "a long, b long")


def _forest(comp_a: np.ndarray, comp_b: np.ndarray, order: np.ndarray) -> list[int]:
    """Pairs, taken in `order`, that join components not joined by earlier ones."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for i in order.tolist():
        a, b = root(int(comp_a[i])), root(int(comp_b[i]))
        if a != b:
            parent[a] = b
            out.append(i)
    return out


def _across(percent: int, take: str):
    """Within each cell, pairs of different components that the bit sketches cannot rule out.

    `take`: "closest" gives a spanning forest of the components by sketch distance, "other" one by a hash of the pair,
    "all" every pair. What passes between near copies nearly always links, so the forests leave little for the last.
    """
    def compare(cell) -> list[tuple[int, int]]:
        side, node, comp, n, bits = cell
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        at, dist = [], []
        for a in range(0, len(left), 64):
            i = left[a:a + 64]
            far = np.bitwise_count(bits[i][:, None, :] ^ bits[right][None, :, :]).sum(axis=2, dtype=np.int64)
            most = (n[i][:, None] + n[right][None, :]) * (100 - percent) // (100 + percent)
            ok = (far <= most) & (comp[i][:, None] != comp[right][None, :])
            ok &= (side[i][:, None] != 0) | (side[right][None, :] != 0) | (node[i][:, None] < node[right][None, :])
            x, y = np.nonzero(ok)
            at.append(np.stack([i[x], right[y]]))
            dist.append(far[x, y])
            if take != "all" and sum(len(d) for d in dist) > 4 * CELL:  # a forest of forests is a forest of all
                at, dist = [np.concatenate(at, axis=1)], [np.concatenate(dist)]
                keep = chosen(at[0], dist[0], node, comp)
                at, dist = [at[0][:, keep]], [dist[0][keep]]
        (p, q), far = np.concatenate(at, axis=1), np.concatenate(dist)
        if take != "all":
            keep = chosen(np.stack([p, q]), far, node, comp)
            p, q = p[keep], q[keep]
        return list(zip(np.minimum(node[p], node[q]).tolist(), np.maximum(node[p], node[q]).tolist(), strict=True))

    def chosen(at, far, node, comp) -> list[int]:
        weight = far if take == "closest" else mix((node[at[0]] ^ node[at[1]]).astype(U))
        return _forest(comp[at[0]], comp[at[1]], np.argsort(weight, kind="stable"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, cell = [], None

        def flush():
            *cols, bits = zip(*waiting, strict=True)
            cols = [np.concatenate(c) for c in cols]
            if len(cols[0]) < 2:
                return None
            found = sorted(set(compare([*cols, _sketches([x for part in bits for x in part])[0]])))
            a, b = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array([cell] * len(a), pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                              names=["cell", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column(0).to_numpy()
            cols = [batch.column(i).to_numpy() for i in (1, 2, 3, 4)]
            bits = batch.column(5).to_pylist()
            edges = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]
            for a, b in zip(edges, edges[1:], strict=False):
                if cell is not None and cells[a] != cell:
                    if (done := flush()) is not None:
                        yield done
                    waiting = []
                cell = cells[a]
                waiting.append([*(c[a:b] for c in cols), bits[a:b]])
        if waiting and (done := flush()) is not None:
            yield done
    return run


def _open_pairs(members: DataFrame, comps: DataFrame, sketches: DataFrame, percent: int, take: str, cells_open: DataFrame | None) -> DataFrame:
    """(cell, a, b): pairs across components that share a key and have not been verified; see the module's text on groups.

    `cells_open` are the cells in which an earlier round found a pair; where it found none there never is one, for components only grow.
    """
    with_comp = members.select("key", "node").join(comps, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    mixed = with_comp.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size")
    ).where(F.col("lo") != F.col("hi")).select("key", F.ceil(F.col("size") / CELL).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    rows = with_comp.join(mixed, "key").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = rows.withColumn("other", other).select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
        F.signum(F.col("block") - F.col("other")).cast("int").alias("side"), "node", "component")
    if cells_open is not None:
        cells = cells.join(cells_open, "cell", "left_semi")
    ready = cells.join(sketches.select("node", "n", "bits"), "node").select("cell", "side", "node", "component", "n", "bits")
    return ready.repartition("cell").sortWithinPartitions("cell").mapInArrow(_across(percent, take), "cell long, a long, b long")


def similar_groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per row of `docs` (doc_id, text): row, doc_id, n_shingles, component_id, keeper.

    component_id is the smallest doc_id reachable by links; `row` is a number of the row that this
    function gives (monotonically_increasing_id) and `keeper` marks one row of each component: the
    smallest by (doc_id, row), NULL ids last. NULL or blank texts have no shingles, link with
    nothing and keep their own id. Repeated rows and rows that share an id are rows of their own, and copies link.
    An empty table gives no rows. Other columns of `docs` are not read.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    info = scratch.keep(rows.mapInArrow(_describe, "row long, doc_id long, n long, node long, bits binary, wide binary"), "rows")
    keys = docs.select("text").mapInArrow(_keys(percent), "key long, node long")
    members = scratch.keep(keys.repartition("key").sortWithinPartitions("key", "node")
                           .mapInArrow(_runs, "key long, node long, centre long"), "members")
    stars = members.groupBy(F.col("centre").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("keys"))
    stars = scratch.keep(stars, "stars")
    nodes = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    texts = _Texts(docs, info, nodes, scratch)
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("keys", -F.col("a"))).alias("a")).select("a", "b")
    links = scratch.keep(verify(best, texts, percent, scratch), "links")
    comps = scratch.keep(components(links, scratch), "components")

    def settle(pairs: DataFrame) -> None:
        nonlocal comps
        more = scratch.keep(verify(pairs.select("a", "b").distinct(), texts, percent, scratch), "more")
        if not more.isEmpty():
            known = comps.select(F.col("component").alias("a"), F.col("node").alias("b"))  # instead of all links so far: the same components
            comps = scratch.keep(components(known.unionByName(more), scratch), "components")

    settle(_across_components(stars.select("a", "b").join(best, ["a", "b"], "left_anti"), comps))
    cells_open = None
    for take in ("closest", "other", "all"):
        pairs = scratch.keep(_open_pairs(members, comps, texts.sketches, percent, take, cells_open), "pairs")
        if pairs.isEmpty():
            break
        settle(pairs)
        cells_open = pairs.select("cell").distinct()
    return _label(info, comps)


def _across_components(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs (a, b) that are in different components; a node without links is its own."""
    of = lambda side: comps.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _label(info: DataFrame, comps: DataFrame) -> DataFrame:
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    per_node = info.where(F.col("n") > 0).groupBy("node").agg(least.alias("first"))
    grouped = per_node.join(comps, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    per_comp = grouped.groupBy("component").agg(F.min("first").alias("first"))
    names = grouped.select("node", "component").join(per_comp, "component").select("node", "first")
    out = info.withColumn("node", F.when(F.col("n") > 0, F.col("node"))).join(names, "node", "left")
    return out.select(
        "row", "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("first.doc_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("keeper"))


def keep_one_per_group(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, without those that `similar_groups` groups with a row of smaller (doc_id, row).

    Rows without shingles stay. `docs` must give its rows in the same order when it is read again, as files do.
    """
    scratch = Scratch(docs.sparkSession, "keep-one")
    gone = scratch.keep(similar_groups(docs.select("doc_id", "text"), percent).where(~F.col("keeper")).select("row"), "gone")
    data = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    marked = may_hold(data, "row", id_bitmap(gone, "row"), "touched")
    stay = marked.where(~F.col("touched")).select("d.*")
    return stay.unionByName(marked.where("touched").join(gone, "row", "left_anti").select("d.*"))
