"""Language identification with hyperdimensional profiles.

Method. Every letter has a random vector of +1 and -1. An n-gram is the
product of its letters' vectors, each permuted (rolled) by its place. A text is
the bundle (sum) of its n-gram vectors; so is a language, over all its training
texts, each with the same weight. A text belongs to the language whose prototype
has the largest cosine with it.

Training reads every training row: tasks add up weighted n-gram counts per
language, Spark sums the bundles, and one vector per language comes back.
Letters beyond the alphabet's cells share cells by code point, so tables and
prototypes have a fixed size whatever the texts hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import held_out

CELLS = 64  # cell 0 is the gap between words
ORDER = 3
UNKNOWN = "und"


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # one unit vector per language
    dim: int
    seed: int


@lru_cache(maxsize=1)
def _cells() -> np.ndarray:
    """Cell of every code point below 0x10000: a-z 1-26, other letters shared over the rest, all else 0."""
    table = np.zeros(0x10000, np.uint8)
    for c in range(0x10000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            low = ord(chr(c).lower()[0])
            table[c] = low - 96 if 97 <= low <= 122 else 27 + low % (CELLS - 27)
    return table


def _codes(text: str) -> np.ndarray:
    """The n-gram codes of a text: runs of non-letters count as one gap, and a gap stands at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _cells()
    cells = table[np.minimum(points, 0xFFFF)]
    beyond = np.flatnonzero(points > 0xFFFF)
    for i in beyond.tolist():
        cells[i] = 27 + int(points[i]) % (CELLS - 27) if chr(points[i]).isalpha() else 0
    keep = cells != 0
    keep[1:] |= cells[:-1] != 0
    cells = cells[keep].astype(np.int32)
    if not cells.any():
        return cells[:0]
    cells = np.concatenate([[0], cells, [0]]).astype(np.int32)
    if cells[-2] == 0:
        cells = cells[:-1]
    if len(cells) < ORDER:
        return cells[:0]
    return (cells[:-2] * CELLS + cells[1:-1]) * CELLS + cells[2:]


class _Grams:
    """Vectors of the n-grams met so far in this task, built when first needed; at most CELLS ** ORDER rows."""

    def __init__(self, dim: int, seed: int):
        rng = np.random.default_rng(seed)
        letters = rng.integers(0, 2, (CELLS, dim), dtype=np.int8) * 2 - 1
        self.rolled = [np.roll(letters, ORDER - 1 - k, axis=1) for k in range(ORDER)]
        self.row = np.full(CELLS ** ORDER, -1, np.int32)
        self.vectors = np.zeros((1024, dim), np.int8)
        self.used = 0

    def rows(self, codes: np.ndarray) -> np.ndarray:
        new = codes[self.row[codes] < 0]
        if len(new):
            end = self.used + len(new)
            if end > len(self.vectors):
                grown = np.zeros((max(end, 2 * len(self.vectors)), self.vectors.shape[1]), np.int8)
                grown[:self.used] = self.vectors[:self.used]
                self.vectors = grown
            a, b, c = new // CELLS ** 2, new // CELLS % CELLS, new % CELLS
            self.vectors[self.used:end] = self.rolled[0][a] * self.rolled[1][b] * self.rolled[2][c]
            self.row[new] = np.arange(self.used, end)
            self.used = end
        return self.row[codes]


@lru_cache(maxsize=2)
def _grams(dim: int, seed: int) -> _Grams:
    return _Grams(dim, seed)


def _bundles(dim: int, seed: int):
    """Per task and language the sum of the texts' bundles, each text with weight 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                codes = _codes(text) if text else ()
                if len(codes):
                    lang = lang.as_py()
                    if lang not in weights:
                        weights[lang] = np.zeros(CELLS ** ORDER)
                    found, n = np.unique(codes, return_counts=True)
                    weights[lang][found] += n / len(codes)
        grams = _grams(dim, seed)
        for lang, w in weights.items():
            codes = np.flatnonzero(w).astype(np.int32)
            rows, total = grams.rows(codes), np.zeros(dim)
            for a in range(0, len(rows), 4096):
                total += w[codes[a:a + 4096]] @ grams.vectors[rows[a:a + 4096]].astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(total)],
                names=["lang", "at", "value"])
    return run


def learn(train: DataFrame, dim: int = 512, seed: int = 11) -> Profiles:
    """Prototypes from all rows of `train` (lang, text) with a language; dim values per language come to the driver."""
    parts = (train.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string"), "text")
             .mapInArrow(_bundles(dim, seed), "lang string, at int, value double"))
    sums = parts.groupBy("lang", "at").agg(F.sum("value").alias("value"))
    lists = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("v"))
    rows = lists.select("lang", "v.value").orderBy("lang").collect()
    matrix = np.array([r.value for r in rows]).reshape(len(rows), dim)
    if len(rows) > 1:
        matrix = matrix - matrix.mean(axis=0)  # what all languages share tells none from another
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return Profiles([r.lang for r in rows], matrix / np.where(norms == 0, 1, norms), dim, seed)


def _predict(profiles, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = profiles.value
        grams, prototypes = _grams(p.dim, p.seed), p.prototypes.T.astype(np.float32)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(text_at):
                text = text.as_py()
                codes = _codes(text) if text else ()
                if not len(codes) or not p.languages:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                found, n = np.unique(codes, return_counts=True)
                rows = grams.rows(found)  # may replace grams.vectors
                bundle = n.astype(np.float32) @ grams.vectors[rows].astype(np.float32)
                cosines = bundle @ prototypes / max(float(np.linalg.norm(bundle)), 1e-12)
                best = int(np.argmax(cosines))
                langs.append(p.languages[best])
                scores.append(float(np.clip((1 + cosines[best]) / 2, 0, 1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])
    return run


def predict(docs: DataFrame, profiles: Profiles, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` of every row with lang_pred and score, the cosine scaled to 0..1.

    NULL texts and texts without a letter get `und` and 0. Ties go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    df = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_predict(shared, len(keep)), f"{fields}, lang_pred string, score double").drop("__text")


def identify(docs: DataFrame) -> DataFrame:
    """Learn on the rows outside the evaluation fold, predict every row of `docs` (doc_id, text, lang)."""
    rows = docs.select("doc_id", "lang", "text", held_out(F.col("doc_id")).alias("held_out"))
    profiles = learn(rows.where(~F.col("held_out")))
    return predict(rows, profiles, ["doc_id", "held_out"])
