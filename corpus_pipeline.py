"""A corpus pipeline over `documents`: score, cut, deduplicate, decontaminate, encode.

STAGES lists (name, function) in order. A function takes (spark, docs, sf_dir) and returns what
it keeps; the result is written as Parquet and read again as the next one's docs. All stages
but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.llm.bpe import encode_digest
from metroflux.llm.common import Scratch, read_table
from metroflux.llm.decontaminate import drop_contaminated
from metroflux.llm.jaccard import keep_one_per_group
from metroflux.llm.line_dedup import drop_repeated_lines
from metroflux.llm.toxicity import reject_toxic

VOCABULARY = "word_bpe_49k.json"

# Rows of an Arrow batch between Spark and its Python workers: whole texts are large rows, and every worker holds a batch on both sides.
ARROW_ROWS = 2000
_ARROW_ROWS, _BUILT_IN = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(stage):
    """Decorator of a stage: its session has batches of ARROW_ROWS, also when the result is written after the call."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(_ARROW_ROWS) == _BUILT_IN:  # whatever else the session says stays
            spark.conf.set(_ARROW_ROWS, ARROW_ROWS)
        return stage(spark, docs, sf_dir)
    return run_stage


@small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from `labels`."""
    return reject_toxic(docs, read_table(spark, sf_dir, "labels"))


@small_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out of the texts; n_chars follows. Short whole copies are left to the next stage."""
    out = drop_repeated_lines(docs, whole_texts=False)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


@small_batches
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id stays."""
    return keep_one_per_group(docs)


@small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@small_batches
def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of tokens, and digests of the ids and of what they decode to."""
    return encode_digest(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("jaccard_join", jaccard_join),
          ("decontamination", decontamination), ("bpe", bpe)]

# The first stage is a trained network, and tokens are not SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`, each to the written result of the one before."""
    docs = read_table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
