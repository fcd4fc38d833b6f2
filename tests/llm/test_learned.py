"""Language identification, toxicity and the secret scan: held-out accuracy, gradients, odd inputs."""
import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from metroflux.llm import language_id as L
from metroflux.llm import toxicity as X
from metroflux.llm.common import held_out

DIR = "/root/testdata/sf0.01"


def test_language_accuracy_held_out(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    r = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.a >= 0.95 and 0 <= r.lo and r.hi <= 1


def test_language_ignores_id_and_source_and_label(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(300)
    p = L.learn(docs.select("lang", "text"))
    one = {r.text: r.lang_pred for r in L.predict(docs, p, ["text"]).collect()}
    other = L.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), p, ["text"]).collect()
    assert {r.text: r.lang_pred for r in other} == one


def test_language_odd_rows(spark):
    rows = [(i, "the quick brown fox jumps over it", "en", 1.0) for i in range(1, 9)] + [(i, "der schnelle braune Fuchs springt", "de", 1.0) for i in range(9, 17)]
    rows += [(None, "the fox", None, 1.0), (20, None, "en", 1.0), (21, "", "en", 1.0), (22, "12 -- 34", "de", 1.0), (23, "日本 ß", None, 1.0), (23, "a", "en", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = L.identify(df).collect()
    assert len(out) == len(rows) and {r.lang_pred for r in out if r.doc_id in (20, 21, 22)} == {"und"}
    assert all(0 <= r.score <= 1 for r in out) and {r.lang_pred for r in out} <= {"en", "de", "und"}
    assert L.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in L.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_long_runs_of_letters_are_read_to_their_end():
    run = "a" * 200
    assert X.words_of(f"x {run}b y") == ["x", "a" * 64, "a" * 64, "a" * 64, "a" * 8 + "b", "y"]
    net = X.Network.new({}, 0.5, 1)
    scores = X.Scorer(net).scores(["z" * 64 + tail for tail in ("abc", "xyz", "")])
    assert len(set(scores.tolist())) == 3  # what follows the first 64 letters counts


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = X.Network.new({"bad": 1, "good": 2}, 0.3, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["word"] += 0.3
    net.p["word"][0] = 0
    words = ["bad", "good", "other", "x"]
    at = np.full((3, X.WINDOW), -1)
    at[0, :7], at[1, :], at[2, :2] = rng.integers(0, 4, 7), rng.integers(0, 4, X.WINDOW), [0, 3]
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        both = net.gates_in(words)
        z = net.logits(both[at] * (at >= 0)[:, :, None], at >= 0)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    g = net.gradients(words, at, y)
    for name in net.p:
        flat, gf = net.p[name].reshape(-1), g[name].reshape(-1)
        for i in sorted(np.argsort(-np.abs(gf))[:3]):
            keep, step = flat[i], 1e-3
            flat[i] = keep + step
            up = loss()
            flat[i] = keep - step
            down = loss()
            flat[i] = keep
            assert abs((up - down) / (2 * step) - gf[i]) < 2e-3 * max(0.05, abs(gf[i])) + 2e-5, name


def test_windows_overlap_and_cover():
    for n in (1, 5, 32, 33, 48, 49, 1000):
        at = X.windows(n)
        assert set(at[at >= 0].tolist()) == set(range(n)) and at.shape[1] == X.WINDOW
        assert len(at) == 1 or (np.diff(at[:, 0]) <= X.STRIDE).all()


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    some = docs.join(F.broadcast(labels.select("doc_id")), "doc_id").select("doc_id", "text")
    out = X.rate_documents(some, labels, train_rows=1500).join(labels, "doc_id").where("held_out")
    r = out.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("double")).alias("a"),
                F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.a >= 0.93 and 0 <= r.lo and r.hi <= 1


def test_toxicity_odd_rows(spark, frame):
    rng = random.Random(1)
    clean = ["sun", "tree", "river", "stone", "bird", "cloud"]
    rows = [(i, " ".join(rng.choice(clean) for _ in range(rng.randint(1, 90))) + (" nasty" if i % 3 == 0 else "")) for i in range(240)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)] + [(None, 1, 1), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows += [(900, None), (901, ""), (902, "12 34"), (None, "sun nasty"), (903, "tree " * 2000), (903, "tree " * 900 + "NASTY!! " + "sun " * 900)]
    out = X.rate_documents(frame(rows), labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == 0 for r in out if r.doc_id in (900, 901, 902))
    assert sum(r.predicted for r in out if r.doc_id == 903) == 1
    kept = X.reject_toxic(frame(rows), labels)
    assert "score" in kept.columns and kept.count() == sum(r.predicted == 0 for r in out)
    assert X.rate_documents(frame([]), labels).count() == 0
    assert X.rate_documents(frame(rows), labels.limit(0)).count() == len(rows)


def test_fold(spark):
    import zlib
    got = {r.i: r.h for r in spark.range(200).select(F.col("id").alias("i"), held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def test_scoring_remembers_no_trigrams():
    X.trigrams.cache_clear()
    assert X.Scorer(X.Network.new({}, 0.1, 1)).scores(["several words are here", None]).shape == (2,)
    assert X.trigrams.cache_info().currsize == 0  # a scored word's gates are remembered already


def test_training_holds_numbers_instead_of_words():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=1500)) for _ in range(1200)]
    tracemalloc.start()
    net = X.train((t for t in texts), [i % 2 for i in range(len(texts))], per_text=1, steps=1, refine=1)
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert most < 120, most  # 171 MB as lists of words, windows and trigrams
    assert len(net.vocabulary) == 20_000


def test_sample_batches_are_the_windows():
    texts = ["one two three one", None, "two " * 40 + "four", "", "Five"]
    sample = X.Sample(texts)
    assert [sample.words(i) for i in range(5)] == [X.words_of(t) for t in texts]
    assert [sample.distinct[i] for i in sample.frequent(2, 9)] == ["two"]
    text, start = np.array([2, 0, 4]), np.array([9, 0, 0])
    words, at = sample.batch(text, start)
    names = [sample.distinct[i] for i in words]
    assert names == ["two", "four", "one", "three", "five"]  # in the order in which they come
    assert [[names[i] for i in row if i >= 0] for row in at.tolist()] == [["two"] * 31 + ["four"], ["one", "two", "three", "one"], ["five"]]
    flat, sizes = sample.trigrams_of(words)
    assert [part.tolist() for part in np.split(flat, np.cumsum(sizes)[:-1])] == [X.trigrams(w) for w in names]
