import math

import numpy as np
from pyspark.sql import functions as F

from metroflux.llm.topk import search


def brute(rows, k, every):
    fine = [(i, np.array([math.floor(256 * float(np.float32(x))) for x in v])) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in fine:
        if q % every == 0:
            s = sorted((-int(qv @ v), i) for i, v in fine if i != q and len(v) == len(qv))[:k]
            out += [(q, r, i, -neg) for r, (neg, i) in enumerate(s, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).withColumn("rank", F.lit(1)).withColumn("block", F.lit("x"))
    return sorted(tuple(r) for r in search(df, **kw).collect())


def test_equals_brute_force_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(6).round(1 if i % 3 else 0)]) for i in range(300)]
    rows += [(1000, None), (1001, []), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1005, [float("nan")] * 6), (1010, [float("inf")] + [0.0] * 5),
             (None, [1.0] * 6), (2000, [1.0, 2.0]), (2001, [3.0, -1.0])]
    rows += [(400 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(40)]
    want = brute(rows, 5, 10)
    assert run(spark, rows, k=5, every=10, block=16, cell_queries=8, cell_blocks=4) == want
    assert run(spark, rows, k=5, every=10) == want


def test_fewer_candidates_than_k_and_empty(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])], k=5, every=50) == [(0, 1, 1, 256 * 512)]
    assert run(spark, [(0, [1.0])], k=5, every=50) == []
    assert run(spark, [], k=5, every=50) == []
