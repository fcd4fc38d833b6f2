import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from metroflux.llm.negatives import NO_THRESHOLD, Index, mine


def brute(rows, every, positives, negatives, low, high):
    fine = [(i, label, np.array([math.floor(256 * float(x)) for x in v], object)) for i, label, v in rows
            if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, v) in enumerate(fine):
        if i % every:
            continue
        scored = [(-int(v @ w), j, other) for b, (j, other, w) in enumerate(fine) if b != a and len(w) == len(v)]
        for neg_ps, p, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            window = sorted(s for s in scored if s[2] != label and low * -neg_ps <= -100 * s[0] <= high * -neg_ps)[:negatives]
            out += [(i, p, r, j, -neg_ps, -s) for r, (s, j, _) in enumerate(window, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").repartition(3)
    for name in ("row", "w", "shard", "rank", "t", "dim"):
        df = df.withColumn(name, F.lit("x"))
    return sorted(tuple(r) for r in mine(df, **kw).collect())


ODD = [(None, 1, [1.0] * 6), (1000, None, [1.0] * 6), (1010, 1, None), (1020, 1, []), (1030, 2, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
       (1040, 2, [float("nan")] * 6), (1050, 2, [float("-inf")] + [0.0] * 5), (1060, 3, [1.0, 2.0]), (1061, 3, [3.0, 1.0]), (1062, 4, [1.0, 1.0]),
       (1070, 3, [0.0] * 6)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((4, 6))
    out = []
    for i in range(400):
        label = int(rng.integers(4)) if i % 3 else 0  # one label holds a good third
        out.append((i, label, [float(x) for x in (centre[label] * 0.4 + rng.standard_normal(6)).round(1 if i % 4 else 0)]))
    out += [(2000 + i % 5, i % 2, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(30)]  # repeated rows and ids
    return out + ODD


@pytest.mark.parametrize("kw", [{}, {"shard": 120}, {"shard": 600, "steps": (1, 2, 4, 8)}, {"steps": (1,)}])
def test_equals_brute_force(spark, rows, kw):
    args = {"every": 10, "positives": 3, "negatives": 4, "low": 30, "high": 90}
    want = brute(rows, **args)
    assert len(want) > 200
    assert run(spark, rows, **args, **kw) == want


def test_numbers_beyond_doubles(spark):
    rng = np.random.default_rng(8)
    rows = [(i, i % 2, [float(x) for x in rng.integers(1, 1 << 21, 3)]) for i in range(60)]
    args = {"every": 10, "positives": 2, "negatives": 3, "low": 30, "high": 90}
    assert run(spark, rows, **args) == brute(rows, **args)


def test_few_rows_and_empty(spark):
    args = {"every": 100, "positives": 5, "negatives": 10, "low": 30, "high": 90}
    rows = [(0, 1, [1.0]), (1, 1, [2.0]), (2, 2, [1.0]), (3, 2, [-1.0]), (4, 2, [1.8])]
    assert run(spark, rows) == brute(rows, **args) == [(0, 1, 1, 4, 131072, 256 * math.floor(256 * 1.8)), (0, 1, 2, 2, 131072, 65536)]
    assert run(spark, rows[:2]) == [] == run(spark, rows[:1]) == run(spark, [])
    assert run(spark, [(0, 1, [1.0]), (1, 1, [-2.0]), (2, 2, [-1.0])]) == []  # a negative positive leaves no window


def test_search_finds_all_above_the_threshold_and_lists_few():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (500, 32)) // (1 + np.arange(32))
    index = Index(np.arange(500), np.arange(500), np.zeros(500, int), x)
    q = rng.integers(-50, 50, (20, 32)) // (1 + np.arange(32))
    for t in (NO_THRESHOLD, -10, 0, 500, 3000, 10 ** 9):
        for v, (at, scores) in zip(q, index.search(q, np.full(20, t), np.ones((20, 500), bool)), strict=True):
            every = x @ v
            assert sorted(at) == np.flatnonzero(every >= t).tolist() and (scores == every[at]).all()
