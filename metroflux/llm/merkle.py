"""Merkle manifest of a dataset: digests of rows, one tree per source, one tree over the sources, proofs per row.

Trees. A leaf is the SHA-256 of a row's fields. While several nodes remain, every three consecutive ones (the last
run may be shorter, even one) become the SHA-256 of their digests; a lone leaf is its own root. The roots of the
sources are the leaves of one more tree of the same kind.

Layout. A tree is stored as aligned subtrees of at most HEIGHT levels of parents (3 ** HEIGHT leaves), a row of a table
each. Inside a block the nodes lie in van Emde Boas order: the levels are split at half height, first the
upper subtree, then the lower ones one after another, each laid out likewise. `address` computes a node's place from
its depth and index alone, for building as for finding siblings. The roots of the blocks are the leaves of the next
table of blocks, until one block is left per tree.

Scale. Texts never move: leaves are hashed where they are read, by Spark's own functions. Rows are ranked inside
their source by a range partitioning of (source, id), with the number of rows before a partition added, so a source that holds
a third of all rows spans many partitions. A block holds a bounded number of leaves whatever its source. Going down,
one path per block meets the block's own nodes. The driver sees one number per level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import Scratch

ARITY = 3
HEIGHT = 6


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of fields, each `-` if NULL, else its UTF-8 length, a colon and its text."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256)


# --- address arithmetic of a block -----------------------------------------------------------

def nodes_in(levels: int) -> int:
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place of the nodes `index` of one depth (0 is the root) in a block of `levels` levels, in van Emde Boas order."""
    index = np.asarray(index, np.int64)
    base = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth -= top
        subtree, index = np.divmod(index, ARITY ** depth)
        base += nodes_in(top) + subtree * nodes_in(levels - top)
        levels -= top
    return base


@lru_cache(maxsize=16)
def _addresses(levels: int) -> list[list[int]]:
    return [address(levels, d, np.arange(ARITY ** d)).tolist() for d in range(levels)]


def levels_of(size: int, height: int) -> int:
    """Levels of the blocks of a tree of `size` nodes: a tree of one block ends where one node is left."""
    levels = 1
    while levels <= height and ARITY ** (levels - 1) < size:
        levels += 1
    return levels


def _widths(levels: int, leaves: int) -> list[int]:
    """Number of nodes at every depth over `leaves` leaves."""
    out = [leaves]
    for _ in range(levels - 1):
        out.append(-(-out[-1] // ARITY))
    return out[::-1]


def build_block(leaves: list[bytes], levels: int) -> bytes:
    """The digests of a block in layout order; places without a node are zeros."""
    at, widths = _addresses(levels), _widths(levels, len(leaves))
    nodes = [bytes(32)] * nodes_in(levels)
    for i, d in enumerate(leaves):
        nodes[at[-1][i]] = d
    for depth in range(levels - 2, -1, -1):
        below = at[depth + 1]
        for i in range(widths[depth]):
            run = range(i * ARITY, min((i + 1) * ARITY, widths[depth + 1]))
            nodes[at[depth][i]] = hashlib.sha256("".join([nodes[below[j]].hex() for j in run]).encode()).digest()
    return b"".join(nodes)


def block_paths(nodes: bytes, levels: int, leaves: int, above: list[tuple[str, str]]) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """Per leaf of a block its digest and its path: (digests before, digests after) in its run, leaf level first."""
    at, widths = _addresses(levels), _widths(levels, leaves)
    paths = [above]
    for depth in range(1, levels):
        hexes = [nodes[32 * a:32 * a + 32].hex() for a in at[depth][:widths[depth]]]
        paths = [[("".join(hexes[i - i % ARITY:i]), "".join(hexes[i + 1:i - i % ARITY + ARITY])), *paths[i // ARITY]]
                 for i in range(widths[depth])]
    for i in range(leaves):
        a = 32 * at[-1][i]
        yield nodes[a:a + 32].hex(), paths[i]


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings of its path lead to."""
    for before, after in path:
        leaf = digest(before, leaf, after)
    return leaf


def _write_path(path: list[tuple[str, str]]) -> str:
    return "/".join([f"{before}:{after}" for before, after in path])


def _read_path(text: str) -> list[tuple[str, str]]:
    return [tuple(step.split(":")) for step in text.split("/")] if text else []


# --- forests: many trees, stored as tables of blocks -------------------------------------------

def ranked(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """`rows` with `place` (from 0, by `order`, NULLs first) inside their `tree`, and the tree's `size`.

    Equal rows are told apart by `row`, so a group of copies spans partitions too.
    """
    keys = ["tree", *order, "row"]
    lined = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    lined = scratch.keep(lined, "lined")
    part = F.shiftright("at", 33)
    runs = lined.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col("tree").alias("of"), "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("n").over(tree).alias("size"))
    same = F.col("tree").eqNullSafe(F.col("of")) & (part == F.col("part"))
    return lined.join(runs, same).withColumn("place", F.col("at") + F.col("shift")).drop("of", "part", "shift", "at", "row")


def _build(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, roots = [], []
            for size, items in zip(batch.column("size").to_pylist(), batch.column("items"), strict=True):
                leaves = [bytes.fromhex(x) for x in items.values.field("digest").to_pylist()]
                nodes.append(build_block(leaves, levels_of(size, height)))
                roots.append(nodes[-1][:32].hex())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary()), pa.array(roots, pa.string())],
                                             names=[*batch.schema.names, "nodes", "root"])
    return run


def build_forest(rows: DataFrame, payload: list[str], scratch: Scratch, height: int = HEIGHT) -> list[DataFrame]:
    """The tables of blocks over `rows` (tree, size, place, digest, payload columns), lowest first.

    A block row: tree, block, size (of the tree at this level), items (place and payload of its leaves, in
    order), nodes (digests in layout order), root. The last table has one block per tree.
    """
    fan = ARITY ** height
    tables, extra = [], payload
    while True:
        item = F.struct("place", "digest", *extra)
        block = F.floor(F.col("place") / fan).cast("long")
        packed = rows.groupBy("tree", block.alias("block")).agg(
            F.max("size").alias("size"), F.sort_array(F.collect_list(item)).alias("items"))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields) + ", nodes binary, root string"
        built = packed.mapInArrow(_build(height), schema).withColumn("items", F.transform("items", lambda x: x.dropFields("digest")))
        tables.append(scratch.keep(built, f"blocks{len(tables)}"))
        top = tables[-1].agg(F.max("block")).first()[0]
        if not top:
            return tables
        extra = []
        rows = tables[-1].where(F.col("size") > fan).select(
            "tree", F.ceil(F.col("size") / fan).cast("long").alias("size"), F.col("block").alias("place"),
            F.col("root").alias("digest"))


def tree_roots(tables: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """(tree, root) of every tree: the root of the only block at its highest level."""
    tops = [t.where(F.col("size") <= ARITY ** height).select("tree", "root") for t in tables]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _down(height: int):
    """From blocks with the path above them: one row per leaf with its own path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree, size, above, subroot, root = (batch.column(c)[i].as_py() for c in ("tree", "size", "above", "subroot", "root"))
                items, nodes = batch.column("items")[i].values, batch.column("nodes")[i].as_py()
                n = len(items)
                found = list(block_paths(nodes, levels_of(size, height), n, _read_path(above)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * n, pa.string()), items, pa.array([d for d, _ in found], pa.string()),
                     pa.array([_write_path(p) for _, p in found], pa.string()), pa.array([subroot] * n, pa.string()),
                     pa.array([root] * n, pa.string())],
                    names=["tree", "item", "leaf", "path", "subroot", "root"])
    return run


def descend(tables: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per leaf of the forest: tree, item, leaf, path, subroot, root. `above` holds each tree's (tree, above, subroot, root).

    `path` goes from the leaf to the root: levels joined by `/`, each the digests before and after in the run, joined by `:`.
    """
    above = above.withColumnRenamed("tree", "of")
    one = F.col("size") <= ARITY ** height  # such a tree ends at this level
    same = F.col("tree").eqNullSafe(F.col("of"))
    columns = ["tree", "size", "items", "nodes", "above", "subroot", "root"]
    found = None
    for table in reversed(tables):
        here = table.drop("root")
        blocks = here.where(one).join(above, same).select(*columns)
        if found is not None:
            up = found.select(F.col("tree").alias("of"), F.col("item.place").alias("at"), F.col("path").alias("above"), "subroot", "root")
            blocks = blocks.unionByName(here.where(~one).join(up, same & (F.col("block") == F.col("at"))).select(*columns))
        kind = here.schema["items"].dataType.elementType.simpleString()
        found = blocks.mapInArrow(_down(height), f"tree string, item {kind}, leaf string, path string, subroot string, root string")
    return found


# --- manifest of a table ------------------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    """Written tables of blocks: one forest of a tree per source, and the tree over the sources' roots."""

    sources: list[DataFrame]
    top: list[DataFrame]
    scratch: Scratch
    height: int

    def subroots(self) -> DataFrame:
        """(source, subroot)"""
        return tree_roots(self.sources, self.height).select(F.col("tree").alias("source"), F.col("root").alias("subroot"))

    def root(self) -> DataFrame:
        """(root): one row, none for an empty table"""
        return tree_roots(self.top, self.height).select("root")

    def proofs(self) -> DataFrame:
        """Per row: source, item (place and the payload columns), leaf, path, subroot, root; see `descend`."""
        over = self.root().select(F.lit(None).cast("string").alias("tree"), F.lit("").alias("above"),
                                  F.lit("").alias("subroot"), "root")
        tops = descend(self.top, over, self.height)
        above = tops.select(F.col("item.source").alias("tree"), F.col("path").alias("above"), F.col("leaf").alias("subroot"), "root")
        return descend(self.sources, self.scratch.keep(above, "above"), self.height).withColumnRenamed("tree", "source")


def build_manifest(leaves: DataFrame, order: list[str], payload: list[str], scratch: Scratch, height: int = HEIGHT) -> Manifest:
    """The manifest of `leaves`: source, digest and the columns of `order` and `payload`.

    Leaves of a source stand by `order` (NULLs first), then by digest; rows alike in both are interchangeable, as copies
    in all fields are. A NULL source is a source, the first one; sources stand by their UTF-8 bytes.
    """
    rows = leaves.select(F.col("source").alias("tree"), "digest", *payload, *[c for c in order if c not in payload])
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    sources = build_forest(ranked(rows, [*order, "digest"], scratch), payload, scratch, height)
    roots = tree_roots(sources, height).select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("source"),
                                       F.col("root").alias("digest"), F.lit(0).cast("long").alias("row"))
    top = build_forest(ranked(scratch.keep(roots, "roots"), ["source"], scratch), ["source"], scratch, height)
    return Manifest(sources, top, scratch, height)


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proofs, folded = [], []
        for leaf, path in zip(batch.column("checked").to_pylist(), batch.column("path").to_pylist(), strict=True):
            path = _read_path(path)
            proofs.append(digest(*[x for step in path for x in step]))
            folded.append(fold(leaf, path))
        keep = [batch.column(c) for c in ("doc_id", "leaf", "subroot", "root")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
                                         names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def check_documents(docs: DataFrame, tampered: Column, other_text: Column, height: int = HEIGHT) -> DataFrame:
    """Per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The manifest is built over the rows as they are. Where `tampered` holds, the row is then checked with `other_text` as its text:
    folded_root is what that leaf and the original siblings lead to, and `verified` tells whether it is the root.
    proof_sha256 is the digest of all siblings, leaf level first. NULL fields have a mark of their own, so NULL and
    empty texts differ; a NULL `tampered` is none. Texts of any length are hashed whole. Rows with NULL ids come first in their source; repeated rows
    are leaves of their own, in digest order. An empty table gives no rows. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    of = lambda text: leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    leaves = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                         of(F.col("text")).alias("digest"), F.when(tampered, of(other_text)).alias("other"))
    proofs = build_manifest(leaves, ["doc_id"], ["doc_id", "other"], scratch, height).proofs()
    checked = proofs.select("item.doc_id", "leaf", F.coalesce("item.other", "leaf").alias("checked"), "path", "subroot", "root")
    out = checked.mapInArrow(_check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
