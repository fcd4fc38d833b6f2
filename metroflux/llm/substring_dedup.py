"""Substring dedup by hashing normalised units of text.

Method. A text is cut into units: lines, and within them sentences, so that a
passage copied into the middle of a line still has units of its own. A unit is
normalised (ASCII letters in lower case, everything but letters, digits and bytes beyond
ASCII dropped) and hashed. Digests are grouped over the whole corpus; the
earliest occurrence by (doc_id, row, place) is kept and every other one is
removed. Removals carry their character offsets in the original text.

Units of fewer than `min_words` words repeat by chance and are never removed. With `whole`, lines,
paragraphs (ended by blank lines) and whole texts are units beside their sentences, so a repeated passage of
short sentences or short lines goes as one; the minimum holds for the passage, not for what it is made of.
A removed unit inside a larger removed one is not listed again.

Grouping adds up inside the tasks before the shuffle, so a unit that a third of
all documents hold is one row per task there. Only units whose digest repeats
meet the keepers; the rest is dropped before that shuffle by a bitmap of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import Scratch, prune_by_ids, text_buffer, text_slices
from metroflux.llm.words import U, letters, mix, plain, powers

UNIT = ("row long, doc_id long, unit int, start long, end long, words int, digest long, check int, "
        "level int, line int, paragraph int")


@lru_cache(maxsize=1)
def _sentence_ends() -> np.ndarray:
    ends = np.zeros(256, bool)
    ends[[ord(c) for c in ".!?"]] = True
    return ends


def units(data: np.ndarray, offsets: np.ndarray, whole: bool = False) -> tuple[np.ndarray, ...]:
    """Of every unit: text index, start and end byte, number of words, digest, a second, short digest, level (0 to 3:
    sentence, line, paragraph, text), and the index among all sentences of its own, its line's and its paragraph's first one.

    A larger unit that is but one smaller one is left out.
    """
    n = len(data)
    word, ends = plain(), _sentence_ends()
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    text = np.zeros(n + 1, bool)  # a text starts here
    text[offsets] = True
    line = text.copy()
    line[1:] |= data == 10
    edge = line.copy()
    edge[1:n] |= ends[data[:-1]] & blank[1:]
    inside = word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    ws, we = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(letters()[data] * power[:n], out=total[1:])
    hashes = mix((total[we] - total[ws]) * inverse[ws])
    # the sum over a unit's words of hash times a power of the place in the unit, by running sums
    up, down = powers(len(hashes) + 1)
    one, two = np.zeros(len(hashes) + 1, U), np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * up[:len(hashes)], out=one[1:])
    np.cumsum(mix(hashes + U(77)) * up[:len(hashes)], out=two[1:])
    closing = np.flatnonzero(~blank)

    def bounds(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and next word, and end byte, of the stretches between edges that hold words."""
        starts = np.flatnonzero(edges)
        stops, starts = starts[1:], starts[:-1]
        at = np.searchsorted(ws, np.append(starts, n))
        full = at[1:] > at[:-1]
        return at[:-1][full], at[1:][full], stops[full]

    levels = [bounds(edge)]
    if whole:
        opens = np.flatnonzero(line)
        empty = np.diff(np.searchsorted(closing, opens)) == 0
        paragraph = text.copy()
        paragraph[opens[1:][empty]] = True
        levels += [bounds(line), bounds(paragraph), bounds(text)]
    sentence, reach = levels[0][0], np.zeros(len(ws) + 1, np.int64)
    parts = []
    for level, (a, b, stop) in enumerate(levels):
        new = reach[a] != b
        reach[a] = b
        a, b, stop = a[new], b[new], stop[new]
        # spans begin with the first word and end before the blanks that close the unit
        stop = closing[np.searchsorted(closing, stop) - 1] + 1
        number = np.searchsorted(sentence, a)
        around = [np.searchsorted(sentence, x[np.searchsorted(x, a, side="right") - 1]) for x, _, _ in levels[1:3]] or [number, number]
        parts.append((np.searchsorted(offsets, ws[a], side="right") - 1, ws[a], stop, b - a, mix((one[b] - one[a]) * down[a]),
                      mix((two[b] - two[a]) * down[a]) >> U(33), np.full(len(a), level), number, *around))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _unit_batches(min_words: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, doc_id = batch.column(0), batch.column(1)
            for a, b in text_slices(batch.column(2)):
                data, offsets = text_buffer(batch.column(2).slice(a, b - a))
                if not len(data):
                    continue
                doc, start, stop, words, digest, check, level, number, line, paragraph = units(data, offsets, whole)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = chars[offsets]
                sentences = doc[level == 0]
                before = np.searchsorted(sentences, doc)  # sentences of earlier texts
                k = words >= min_words
                at = pa.array(doc[k] + a)
                small = [pa.array((x - before)[k].astype(np.int32)) for x in (number, line, paragraph)]
                yield pa.RecordBatch.from_arrays(
                    [row.take(at), doc_id.take(at), small[0],
                     pa.array((chars[start] - base[doc])[k]), pa.array((chars[stop] - base[doc])[k]),
                     pa.array(words[k].astype(np.int32)), pa.array(digest[k].astype(np.int64)), pa.array(check[k].astype(np.int32)),
                     pa.array(level[k].astype(np.int32)), *small[1:]],
                    names=["row", "doc_id", "unit", "start", "end", "words", "digest", "check", "level", "line", "paragraph"])
    return run


def repeated_units(docs: DataFrame, min_words: int = 8, whole: bool = False) -> DataFrame:
    """Every removed unit of `docs` (doc_id, text): row, doc_id, unit, start, end, words, kept_doc_id, kept_start.

    start and end are character offsets in the original text; kept_doc_id and kept_start say where
    the copy that stays begins. The order that decides is (doc_id, row, unit), NULL ids last; `row` is a number
    of the row given here, so repeated rows and rows that share an id are texts of their own. NULL, empty and
    blank texts have no units. Other columns of `docs` are not read. With `whole`, repeated lines, paragraphs and
    texts are removed as one unit, numbered by their first sentence.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_unit_batches(min_words, whole), UNIT)
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row", "unit", "start")
    keepers = found.groupBy("digest", "check").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("copies"))
    keepers = scratch.keep(keepers.where(F.col("copies") > 1).select("digest", "check", "kept"), "keepers")
    again = prune_by_ids(found, "digest", keepers, "digest").join(keepers, ["digest", "check"])
    again = again.where((F.col("row") != F.col("kept.row")) | (F.col("unit") != F.col("kept.unit")))
    if whole:
        again = _outermost(again)
    return again.select("row", "doc_id", "unit", "start", "end", "words",
                        F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start"))


def _outermost(removed: DataFrame) -> DataFrame:
    """The removed units that lie in no larger removed one."""
    for level, place in ((3, ["row"]), (2, ["row", "paragraph"]), (1, ["row", "line"])):
        covered = F.max(F.col("level") == level).over(Window.partitionBy(*place))
        removed = removed.withColumn("covered", covered).where(~F.col("covered") | (F.col("level") >= level)).drop("covered")
    return removed
