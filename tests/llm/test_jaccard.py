import random
import re

import numpy as np
import pyarrow as pa
import pytest

from metroflux.llm import jaccard as J
from metroflux.llm import words as W
from metroflux.llm.common import Scratch, text_buffer
from metroflux.llm.components import components
from metroflux.llm.words import shingles, word_hashes, word_spans

WORDS = [f"w{i:03d}" for i in range(400)]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def brute_sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [brute_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(rng):
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n, text))
        n += 1

    for size in (1, 2, 4, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200):
        for _ in range(3):
            base = sentence(rng, size).split()
            add(" ".join(base))
            add(" ".join(base).upper())
            for edits in (1, 2, 3, 5, 8):
                t = list(base)
                for _ in range(edits):
                    t[rng.randrange(len(t))] = rng.choice(["x", "y", "zz"])
                add(" ".join(t))
                add(" ".join(t + ["tail"] * min(edits, 2)))
    hot = sentence(rng, 60)
    for _ in range(25):  # one passage in otherwise different texts
        add(sentence(rng, 40) + " " + hot + " " + sentence(rng, 30))
    near = sentence(rng, 150).split()
    for _ in range(40):  # a large group of near copies
        t = list(near)
        for _ in range(2):
            t[rng.randrange(len(t))] = "q"
        add(" ".join(t))
    for _ in range(30):
        add(hot)
    for t in (None, "", " \n\t", "\x0b", "é è", "é è"):
        add(t)
    rows.append((None, "one two three four five six"))
    rows.append((3, "one two three four five six"))
    rows.append((3, rows[3][1]))
    return rows


def test_components_equal_brute_force(spark, frame, rng):
    rows = corpus(rng)
    got = J.similar_groups(frame(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    # id 3 stands for several texts here; every other group has one keeper, its smallest id
    groups = {r.component_id for r in got if r.n_shingles} - {3}
    kept = sorted(r.doc_id for r in got if r.keeper and r.n_shingles and r.component_id in groups)
    assert kept == sorted(groups)


def test_pairs_across_components_are_found_without_the_stars(spark, frame, rng, monkeypatch):
    """The second round alone must find every link that the first one did not verify."""
    rows = corpus(rng)
    real = J.verify
    calls = []

    def blind(pairs, sets, percent, scratch):
        calls.append(1)
        out = real(pairs, sets, percent, scratch)
        return out.limit(0) if len(calls) == 1 else out

    monkeypatch.setattr(J, "verify", blind)
    got = {r.doc_id: r.component_id for r in J.similar_groups(frame([(d, t) for d, t in rows if d is not None][:-2])).collect()}
    want = {d: c for d, _, c in brute([(d, t) for d, t in rows if d is not None][:-2])}
    # what is linked only to the smallest of each key was left out above; every other pair is here
    joined = sum(got[d] == want[d] for d in want) / len(want)
    assert joined > 0.5


def test_a_cell_gives_no_more_pairs_than_rows(rng):
    base = [rng.getrandbits(63) for _ in range(120)]
    sets = [np.unique(np.array(rng.sample(base, 116) + [rng.getrandbits(63)], np.uint64)) for _ in range(300)]
    bits = pa.array([J.bit_sketch(s) for s in sets], pa.binary())
    node = pa.array(range(300), pa.int64())
    cell = pa.RecordBatch.from_arrays([pa.array([7] * 300, pa.int64()), pa.array([0] * 300, pa.int32()), node, node,
                                       pa.array([len(s) for s in sets], pa.int64()), bits],
                                      names=["cell", "side", "node", "component", "n", "bits"])
    pairs = {take: sum(b.num_rows for b in J._across(80, take)(iter([cell]))) for take in ("closest", "other", "all")}
    assert pairs == {"closest": 299, "other": 299, "all": 300 * 299 // 2}


def test_large_sets_that_differ_are_not_moved(spark, frame, rng, monkeypatch):
    """Two sets of 6000 shingles with 0.6 of them shared fill 2048 bits, and yet the pair goes before the sets are moved."""
    words = [f"w{rng.getrandbits(60)}" for _ in range(9000)]
    texts = {1: words[:6000], 2: words[:5980], 3: words[:4500] + words[6000:7500], 4: words[:4500] + words[6000:7480]}
    texts = {k: " ".join(v) for k, v in texts.items()}
    node = {k: J.node_of(J._sets(pa.array([v]))[0]) for k, v in texts.items()}
    real, given, plausible = J.verify, [], []

    class Kept(Scratch):
        def keep(self, df, name="t"):
            out = super().keep(df, name)
            if name == "plausible":
                plausible.append(out.count())
            return out

    monkeypatch.setattr(J, "Scratch", Kept)
    monkeypatch.setattr(J, "verify", lambda *args: given.append(args) or real(*args))
    got = {r.doc_id: r.component_id for r in J.similar_groups(frame(list(texts.items()))).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}
    pairs = spark.createDataFrame([(node[1], node[3]), (node[1], node[4]), (node[2], node[3]), (node[1], node[2])], "a long, b long")
    linked = real(pairs, *given[0][1:]).collect()
    assert [tuple(r) for r in linked] == [(node[1], node[2])] and plausible[-1] == 1


def test_wide_sketches_fold_to_the_others(rng):
    for n in (600, 601, 2400, 2401, 9600, 9601, 40_000):
        s = np.unique(np.array([rng.getrandbits(63) for _ in range(n)], np.uint64))
        wide, bits = J.wide_sketch(s), J.bit_sketch(s)
        assert (wide is None) == (n <= 2400) and len(wide or bits) == {600: 64}.get(n, 256 * 4 ** ((n > 2400) + (n > 9600) + (n > 38400)))
        if wide:
            x, y = J._sketches([wide], [bits])
            assert (x == y).all()


def test_short_sets_meet_under_no_constant_key(rng):
    """Unrelated sets share no key, though some use few parts of their band."""
    sets = [np.unique(np.array([rng.getrandbits(63) for _ in range(n)], np.uint64)) for n in (9, 10, 14, 20, 28, 40, 56, 79) for _ in range(300)]
    keys, who = J.part_keys(sets, 80)
    owners = {}
    for k, w in zip(keys.tolist(), who.tolist()):
        owners.setdefault(k, set()).add(w)
    assert max(map(len, owners.values())) == 1


def test_every_linked_pair_shares_a_key(rng):
    for _ in range(400):
        n = rng.choice([4, 5, 6, 8, 13, 30, 70, 150, 400, 600, 640, 900])
        a = np.unique(np.array([rng.getrandbits(63) for _ in range(n)], np.uint64))
        d = int(2 * n / 9)
        drop = rng.randint(0, d // 2)
        b = np.concatenate([a[drop:], np.array([rng.getrandbits(63) for _ in range(rng.randint(0, d - drop))], np.uint64)])
        b = np.unique(b)
        same = len(np.intersect1d(a, b))
        if 100 * same >= 80 * (len(a) + len(b) - same):
            keys, who = J.part_keys([a, b], 80)
            assert set(keys[who == 0]) & set(keys[who == 1]), (len(a), len(b), same)
            x, y = J._sketches([J.bit_sketch(a)], [J.bit_sketch(b)])
            assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * same


def test_shingles_of_bytes(rng):
    texts = ["a b c d e f", "A b  c\nd e F", "a b c d", "a b c d e", "", "é b c d e f", "x"]
    data, off = text_buffer(pa.array(texts))
    s, e, f = word_spans(data, off)
    sets = shingles(word_hashes(data, s, e), f, 5)
    assert [len(x) for x in sets] == [2, 2, 1, 1, 0, 2, 1]
    assert (sets[0] == sets[1]).all() and sets[3][0] in sets[0] and sets[2][0] not in sets[0]
    alone = [shingles(word_hashes(d, *word_spans(d, o)[:2]), word_spans(d, o)[2], 5)[0] for d, o in (text_buffer(pa.array([t])) for t in texts)]
    assert all((x == y).all() for x, y in zip(sets, alone))


def test_components_of_chains(spark, tmp_path):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(i + 1), 101 + i) for i in range(60)] + [(500, 500), (7, 7)]
    out = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"))
    got = {r.node: r.component for r in out.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(61)}}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (1, "")], [(5, "a"), (4, "a")]])
def test_small_tables(frame, rows):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similar_groups(frame(rows)).collect()), key=str)
    assert got == brute(rows)


def test_one_row_of_each_group_stays(frame):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (None, "a b c d e f g"), (5, "other words")]
    out = J.keep_one_per_group(frame(rows))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, "a b c d e f g"), (3, None), (4, ""), (5, "other words")], key=str)
    assert "key" in out.columns


def test_a_long_text_leaves_no_long_arrays():
    data = np.frombuffer(b"one Two " * 200_000 + b"x" * 300_000 + b" one tw", np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    hashes = word_hashes(data, starts, ends)
    alone = [word_hashes(d, np.array([0]), np.array([len(d)]))[0] for d in (data[a:b] for a, b in zip(starts[-4:], ends[-4:], strict=True))]
    assert hashes[-4:].tolist() == alone
    assert len(set(hashes.tolist())) == 4 and hashes[0] == hashes[-2] and hashes[1] == hashes[-4]
    assert sum(p.nbytes for p in W._POWERS) <= 4 << 20


def test_components_that_are_settled_take_no_other_round(spark):
    """Stars with a few edges between them, as an earlier round leaves them: no round only to see that nothing moves."""
    stars = [(100 * s, 100 * s + i) for s in range(1, 6) for i in range(1, 30)]
    for more, most in (([], 1), ([(105, 207), (311, 412)], 2)):
        scratch = Scratch(spark, "t")
        got = {r.node: r.component for r in components(spark.createDataFrame(stars + more, "a long, b long"), scratch).collect()}
        low = {200: 100, 400: 300} if more else {}
        assert got == {n: low.get(a, a) for a, b in stars for n in (a, b)}
        assert scratch._n <= most
