"""Token counts per document without ever making token ids per document.

Method. Pieces are counted once per distinct pre-token of the corpus. Each
document contributes its pre-token frequencies; frequency times pieces is
summed per document.

The join of documents with pre-tokens is split by frequency. The most frequent
pre-tokens, which hold nearly all occurrences and would be hot join keys, are
a lookup of bounded size (at most `frequent` entries of at most `frequent_bytes` bytes)
that every task gets, so their occurrences are summed inside the task. They are chosen by a
least frequency, read off a histogram of a few hundred steps; nothing is sorted. Only the
rare rest meets its counts through a shuffle join. The split changes where a
product is formed, never the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.bpe import encoder
from metroflux.llm.common import Scratch, text_slices


def _frequencies(enc, text: str) -> Counter:
    """Pre-token frequencies of one text; special strings are counted as themselves."""
    out: Counter = Counter()
    for piece, special in enc.parts(text):
        if special is not None:
            out[piece] += 1
        else:
            out.update(enc.pretokens(piece))
    return out


def _corpus_frequencies(path: str, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, total = encoder(path), Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(np.fromiter(total.values(), np.int64, len(total)))],
                names=["pretoken", "freq"])

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    for piece, special in enc.parts(text):
                        if special is None:
                            total.update(enc.pretokens(piece))
                if len(total) > flush:
                    yield out()
                    total.clear()
        if total:
            yield out()
    return run


def _count_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n = [len(enc.encode_pretoken(p)) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())],
                                             names=[*batch.schema.names, "pieces"])
    return run


def _document_sums(path: str, lookup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pieces = encoder(path), dict(lookup.value)
        pieces.update(dict.fromkeys(enc.special, 1))
        for batch in batches:
            for a, b in text_slices(batch.column(2), 2 << 20):
                rows, doc_ids, sizes, sums, tokens, freqs = [], [], [], [], [], []
                for row, doc_id, text in zip(*(batch.column(i).slice(a, b - a).to_pylist() for i in range(3)), strict=True):
                    known = 0
                    if text:
                        for token, n in _frequencies(enc, text).items():
                            if (each := pieces.get(token)) is not None:
                                known += n * each
                            else:
                                rows.append(row)
                                doc_ids.append(None)
                                sizes.append(None)
                                sums.append(0)
                                tokens.append(token)
                                freqs.append(n)
                    rows.append(row)
                    doc_ids.append(doc_id)
                    sizes.append(len(text.encode()) if text else 0)
                    sums.append(known)
                    tokens.append(None)
                    freqs.append(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(sums, pa.int64()), pa.array(tokens, pa.string()), pa.array(freqs, pa.int64())],
                    names=["row", "doc_id", "n_bytes", "known", "pretoken", "freq"])
    return run


def pretoken_pieces(docs: DataFrame, path: str, text: str = "text", flush: int = 300_000) -> DataFrame:
    """Every distinct pre-token of the corpus with its frequency and the number of pieces it splits into."""
    counted = docs.select(F.col(text)).mapInArrow(_corpus_frequencies(path, flush), "pretoken string, freq long")
    totals = counted.groupBy("pretoken").agg(F.sum("freq").alias("freq"))
    return totals.mapInArrow(_count_pieces(path), "pretoken string, freq long, pieces long")


def frequent_pieces(pieces: DataFrame, frequent: int, frequent_bytes: int) -> DataFrame:
    """(pretoken, pieces) of pre-tokens from a least frequency on, chosen so that at most `frequent` reach it.

    Frequencies are counted in steps of a sixteenth of an octave, so the histogram has about a thousand rows at most;
    a step that would pass the bound is left out as a whole.
    """
    short = pieces.where(F.octet_length("pretoken") <= frequent_bytes).withColumn("step", F.floor(F.log2("freq") * 16))
    least, room = 1 << 16, frequent  # above every step: no entry
    for r in short.groupBy("step").count().orderBy(F.desc("step")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    return short.where(F.col("step") >= least).select("pretoken", "pieces")


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, frequent: int = 200_000,
                 frequent_bytes: int = 64) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit).

    NULL and empty texts have 0 bytes and 0 tokens; a very long text is counted whole. Repeated rows and NULL ids
    are counted row by row, and an empty table gives no row. Pre-tokens of equal frequency are treated alike. Other columns
    of `docs` are not read, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-counts")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = scratch.keep(pretoken_pieces(docs, path), "pieces")
    top = frequent_pieces(pieces, frequent, frequent_bytes).toArrow()  # bounded by `frequent` and `frequent_bytes`
    lookup = spark.sparkContext.broadcast(dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist(), strict=True)))
    # one row per document with what the lookup covers, and one per rare pre-token of it
    parts = scratch.keep(rows.mapInArrow(_document_sums(path, lookup),
                                         "row long, doc_id long, n_bytes long, known long, pretoken string, freq long"), "parts")
    own = parts.where(F.col("pretoken").isNull()).select("row", "doc_id", "n_bytes", F.col("known").alias("n"))
    rare = (parts.where(F.col("pretoken").isNotNull()).select("row", "pretoken", "freq")
            .join(pieces.select("pretoken", "pieces"), "pretoken")  # every pre-token of a document is one of the corpus
            .select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"),
                    (F.col("freq") * F.col("pieces")).alias("n")))
    return own.unionByName(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens")
    ).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
