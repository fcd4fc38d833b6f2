"""The pipeline against brute force, stage by stage, on the smallest tables."""
import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from metroflux.llm import decontaminate as D
from metroflux.llm.toxicity import rate_documents

from .test_decontaminate import least_distance, words
from .test_jaccard import brute as brute_groups
from .test_line_dedup import brute as brute_lines

DIR = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    kept = {}
    now = docs
    for name, stage in P.STAGES:
        out = stage(spark, now, DIR)
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        kept[name] = now.collect()
    # 1. what the scores say goes, nothing else
    scores = {r.doc_id: r.predicted for r in rate_documents(docs, spark.read.parquet(f"{DIR}/labels.parquet")).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sorted((d, t) for d, t in texts.items() if not scores[d])
    assert sorted((r.doc_id, r.text) for r in kept["toxicity"]) == rows
    # 2. later copies of runs of three lines
    rows = sorted(brute_lines(rows, 3, whole=False))
    assert sorted((r.doc_id, r.text) for r in kept["line_dedup"]) == rows
    assert all(r.n_chars == len(r.text) for r in kept["line_dedup"])
    # 3. one of each group
    first = {d: c for d, n, c in brute_groups(rows)}
    rows = [(d, t) for d, t in rows if first[d] == d]
    assert sorted((r.doc_id, r.text) for r in kept["jaccard_join"]) == rows
    # 4. no document that holds an item within the distance stays (at least: none that holds it exactly)
    items = [words(r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    near = {d: min((least_distance(i, words(t)) / max(1, int(D.most_edits(np.array(len(i))))) for i in items), default=9) if words(t) else 9
            for d, t in rows if len(words(t)) < 1500}
    stay = {r.doc_id for r in kept["decontamination"]}
    assert not [d for d, n in near.items() if n == 0 and d in stay]
    assert not [d for d, n in near.items() if n > 1 and d not in stay]
    rows = [(d, t) for d, t in rows if d in stay]
    # 5. tokens as the library has them
    library = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in kept["bpe"]}
    want = {}
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert got == want


def test_run_applies_all_stages(spark):
    out = P.run(spark, DIR)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() <= spark.read.parquet(f"{DIR}/documents.parquet").count()


def test_every_stage_alone_has_small_batches(spark):
    docs, rows = spark.read.parquet(f"{DIR}/documents.parquet"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    try:
        for name, stage in P.STAGES[1::3]:  # their calls are short: line_dedup and bpe
            for said, then in (("10000", str(P.ARROW_ROWS)), ("300", "300")):
                spark.conf.set(rows, said)
                stage(spark, docs, DIR)
                assert spark.conf.get(rows) == then, name
        assert all(hasattr(stage, "__wrapped__") for _, stage in P.STAGES)
    finally:
        spark.conf.set(rows, before)


def test_stages_take_odd_rows(spark, tmp_path):
    rows = [(1, "a b c d e f", "en", "s", 11), (None, None, None, None, None), (2, "", "de", "s", 0), (2, "a b c d e f", None, "s", 11)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn(
        "row", F.lit(1)).write.parquet(str(tmp_path / "documents"))
    now = spark.read.parquet(str(tmp_path / "documents"))
    for name, stage in P.STAGES:
        stage(spark, now, DIR).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    assert now.count() == 3  # the second copy of the text goes
    empty = spark.read.parquet(str(tmp_path / "documents")).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, DIR).count() == 0
