import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from metroflux.llm import merkle
from metroflux.llm.common import Scratch

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r):
    return h(*(field(r[i]) for i in (0, 1, 2, 3, 4)))


def tree(digests):
    """Root and, per leaf, the (before, after) digests of its path."""
    paths = [[] for _ in digests]
    at = list(range(len(digests)))
    while len(digests) > 1:
        for k, i in enumerate(at):
            run = digests[i // 3 * 3:i // 3 * 3 + 3]
            paths[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
            at[k] = i // 3
        digests = [h(*digests[i:i + 3]) for i in range(0, len(digests), 3)]
    return digests[0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    subs = []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        group = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subs.append((group, *tree([leaf_of(r) for r in group])))
    if not subs:
        return []
    root, upper = tree([s[1] for s in subs])
    out = []
    for (group, sub, paths), above in zip(subs, upper, strict=True):
        for r, path in zip(group, paths, strict=True):
            path = path + above
            odd = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            d = leaf_of((*r[:4], r[4].replace("\n", ""))) if odd else leaf_of(r)
            for b, a in path:
                d = h(b, d, a)
            out.append((r[0], leaf_of(r), sub, root, h(*(x for p in path for x in p)), d, d == root))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("tree", "row", "digest", "place", "root", "size"):
        df = df.withColumn(name, F.lit("x"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    out = merkle.check_documents(df, tampered, F.replace("text", F.lit("\n"), F.lit("")), **kw)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_layout_is_a_permutation_of_aligned_subtrees():
    for levels in range(1, 7):
        every = np.concatenate([merkle.address(levels, d, np.arange(3 ** d)) for d in range(levels)])
        assert sorted(every) == list(range(merkle.nodes_in(levels)))
        top = levels // 2
        for d in range(top, levels):  # each lower subtree lies in one stretch of its own
            place = merkle.address(levels, d, np.arange(3 ** d))
            assert ((place - merkle.nodes_in(top)) // merkle.nodes_in(levels - top) == np.arange(3 ** d) // 3 ** (d - top)).all()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80])
def test_block_equals_brute_force(n):
    leaves = [h(str(i)) for i in range(n)]
    root, paths = tree(leaves)
    levels = merkle.levels_of(n, 6)
    nodes = merkle.build_block([bytes.fromhex(x) for x in leaves], levels)
    assert nodes[:32].hex() == root
    found = list(merkle.block_paths(nodes, levels, n, []))
    assert [d for d, _ in found] == leaves and [p for _, p in found] == paths
    assert all(merkle.fold(d, p) == root for d, p in found)


def test_small_blocks_recurse_over_their_roots(spark):
    rows = [(i, f"s{min(i % 7, 2)}", "en", i, f"line {i}\nmore\n{i * i}") for i in range(60)]
    rows += [(i, "s0", None, None, "copy\ncopy") for i in (5, 5, 5, 5, 5)]
    rows += [(100, None, "en", 1, "a"), (None, None, None, None, None), (None, "ß", "", 0, ""), (101, "", "de", 3, "x\n"),
             (102, "Z", "de", None, "long " * 50_000 + "\n"), (103, "lone", None, 2, None)]
    want = brute(rows)
    assert not all(r[-1] for r in want) and any(r[-1] for r in want)
    assert run(spark, rows) == want
    assert run(spark, rows, height=1) == want


def test_trees_end_in_the_table_of_their_height(spark):
    sizes = {"a": 1, "b": 3, "c": 4, "d": 30}
    rows = [(t, n, i, h(f"{t}{i}")) for t, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "tree string, size long, place long, digest string")
    tables = merkle.build_forest(df, [], Scratch(spark, "forest-test"), height=1)
    assert [t.count() for t in tables] == [14, 5, 2, 1]
    roots = {r.tree: r.root for r in merkle.tree_roots(tables, 1).collect()}
    want = {t: tree([d for s, _, _, d in rows if s == t]) for t in sizes}
    assert roots == {t: w[0] for t, w in want.items()}
    above = spark.createDataFrame([(t, "", r, r) for t, r in roots.items()], "tree string, above string, subroot string, root string")
    got = {(r.tree, r.item.place): (r.leaf, merkle._read_path(r.path)) for r in merkle.descend(tables, above, 1).collect()}
    assert got == {(t, i): (d, want[t][1][i]) for t, _, i, d in rows}


def test_one_row_and_empty(spark):
    rows = [(4, "s", "en", 3, "a\nb")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
