import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from metroflux.llm import decontaminate as D


def words(t):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", t or "")]


def least_distance(item, text):
    """Word edit distance of the item to the nearest stretch of the text."""
    line = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(line[j] + (w != x), line[j + 1] + 1, new[j] + 1))
        line = new
    return min(line)


def cases(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate([3, 5, 8, 12, 17, 25, 34, 35, 50, 80, 40, 30])]
    items += [(50, None), (51, ""), (52, "only two"), (7, items[7][1])]
    docs = []
    for k in range(160):
        i, text = items[rng.randrange(12)]
        t = text.split()
        most = int(D.most_edits(np.array(len(t))))
        for _ in range(rng.choice([0, 0, 1, most // 2, most, most + 3, 3 * most + 5])):
            at = rng.randrange(max(1, len(t)))
            t[at:at + rng.randint(0, 1)] = rng.choice([[], ["zz"], ["zz"]])
        glue = rng.choice([" ", ", ", "\n"])
        docs.append((k, " ".join(say(rng.randint(0, 60))) + " " + glue.join(t).title() + ". " + " ".join(say(rng.randint(0, 60)))))
    docs += [(500 + j, " ".join(say(120))) for j in range(40)] + [(600, None), (601, ""), (602, "..."), (None, items[6][1]), (3, items[8][1])]
    return docs, items


def test_against_brute_force(spark, frame):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(frame(docs), bench).collect()
    found = {(r.doc_id, r.item_id): r for r in got}
    want, exact = {}, set()
    for d, t in docs:
        for i, item in items:
            w = words(item)
            if len(w) >= 3 and words(t):
                n = least_distance(w, words(t))
                if n <= D.most_edits(np.array(len(w))):
                    want[d, i] = n
                    if n == 0:
                        exact.add((d, i))
    assert set(found) <= set(want)  # verified: nothing that is not within the distance
    assert exact <= set(found)
    assert len(found) >= 0.93 * len(want)
    texts = dict(x for x in docs if x[0] not in (None, 3))
    for (d, i), r in found.items():
        if (d, i) in exact and d in texts:
            assert r.distance == 0 and words(texts[d][r.start:r.end]) == words(dict(items)[i])


def test_rows_that_hold_items_go(spark, frame):
    docs, items = cases(9)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(docs)
    bad = {r.doc_id for r in D.contaminated(df, bench).collect()}
    out = D.drop_contaminated(df, bench)
    kept = sorted([r.doc_id for r in out.collect()], key=str)
    assert kept == sorted([d for d, t in docs if d not in bad], key=str) or set(kept) - {3} == {d for d, _ in docs if d not in bad} - {3}
    assert out.columns == df.columns


def test_empty_sides(spark, frame):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert D.contaminated(frame([]), bench).count() == 0
    assert D.contaminated(frame([(1, "one two three four five six")]), bench.limit(0)).count() == 0
    assert D.contaminated(frame([(1, "x one two, three four five six y"), (1, "one two")]), bench).count() == 1


def test_best_end():
    a = np.array([1, 2, 3, 4], np.uint64)
    assert D.best_end(a, np.array([1, 2, 3, 4, 9], np.uint64)) == (0, 4)
    assert D.best_end(a, np.array([1, 2, 9, 3, 4, 9], np.uint64)) == (1, 5)
    assert D.best_end(a, np.array([2, 3, 4], np.uint64)) == (1, 3)
    assert D.best_end(a, np.array([9, 9, 9, 9, 9, 1, 2, 3, 4, 9], np.uint64), free_start=True) == (0, 9)


def test_every_item_at_the_edit_limit_is_found(spark, frame):
    rng = random.Random(5)
    items, docs = [], []
    for i, n in enumerate([6, 9, 12, 15, 16, 19, 25, 34, 50, 59, 80]):
        text = [f"i{i}w{j}" for j in range(n)]
        items.append((i, " ".join(text)))
        most = int(D.most_edits(np.array(n)))
        for kind in ("head", "tail", "even", "random", "random"):
            at = {"head": range(2, n, 3), "tail": range(n - 3, -1, -3), "even": range(0, n, max(1, n // most)),
                  "random": rng.sample(range(n), most)}[kind]
            t = list(text)
            for j in sorted(at[:most], reverse=True):
                t[j:j + 1] = {"head": ["zz"], "tail": ["zz"], "even": ["zz"], "random": rng.choice([[], ["zz"], [t[j], "zz"]])}[kind]
            docs.append((100 * i + len(docs), " ".join([f"p{rng.random()}" for _ in range(30)] + t + [f"s{rng.random()}" for _ in range(30)])))
    docs.append((9000, " ".join([f"p{j}" for j in range(20)] + ["zz" if j in (2, 5, 8, 11, 14) else f"i8w{j}" for j in range(50)])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(frame(docs), bench).collect()}
    want = {(d, i) for d, t in docs for i, item in items if least_distance(words(item), words(t)) <= D.most_edits(np.array(len(words(item))))}
    assert len(want) == len(docs) and found == want


def test_verification_makes_no_python_numbers_of_a_batch():
    n, item = 1500, np.arange(1, 21, dtype=np.uint64)
    window = np.concatenate([np.full(300, 99, np.uint64), item, np.full(280, 98, np.uint64)])
    places = pa.array([np.arange(1000, 1600)] * n, pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array([None] * n, pa.int64()), places, places, pa.array([window.tobytes()] * n),
         pa.array([7] * n, pa.int64()), pa.array([item.tobytes()] * n)],
        names=["row", "doc_id", "starts", "ends", "window", "item_id", "item"])
    tracemalloc.start()
    out, = D._verified(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.to_pylist() == [{"row": i, "doc_id": None, "item_id": 7, "distance": 0, "start": 1300, "end": 1319} for i in range(n)]
    assert peak < 5e6  # as Python numbers the places alone take over 50 MB
