"""Removal of repeated line runs by prefix doubling over line ids; DataFrame functions only.

Method. A text is its sequence of line ids (64-bit line hashes). The corpus' suffixes
are named by prefix doubling: the name of the 2h lines from a place is made from
the names of the h lines there and h lines on. Suffixes with the same name form one
interval of the suffix array: they share that many lines, so the interval's longest
common prefix is at least as long. For a run of any length n the name comes from the two
largest doubled runs inside it, which overlap.

Intervals are taken at depth `min_lines`, and at every lower depth where the shared lines hold `min_words` words; a text
of fewer lines counts besides as a whole, whatever its words. An interval with several members is a repeated run. Its earliest
member by (doc_id, row, line) stays, all others mark their lines. Marked lines that touch
join into the maximal repeated runs of a text, and those runs go. (A longer run is the union of
such intervals, so no greater depth has to be looked at. Order inside an
interval decides nothing here, so ranks need not be sorted numbers: names made alike in
every task serve, and doubling needs no shuffle.)

Only (row, line, name) meets in the shuffle, added up inside the tasks first; texts are
shuffled only for rows that may lose lines, told by a bitmap of fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import Scratch, id_bitmap, may_hold, prune_by_ids


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _paired(names: str, shift: int, length: int) -> Column:
    """Each place's name joined with the one `shift` lines on; empty where the text is too short."""
    names = F.col(names)
    last = F.size(names) - 1 - shift
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.get(names, i), F.get(names, i + shift), F.lit(length)))


def _entries(n: int, min_words: int) -> Column:
    """(line, n, name) of every run of n lines with as many words."""
    every = F.transform(f"names{n}", lambda name, i: F.struct(i.alias("line"), F.lit(n).alias("n"), name.alias("name")))
    words = lambda e: F.aggregate(F.slice("words", e["line"] + 1, n), F.lit(0), lambda a, w: a + w)
    return F.filter(every, lambda e: words(e) >= min_words) if min_words else every


def _starts(docs: DataFrame, min_lines: int, min_words: int, whole_texts: bool) -> DataFrame:
    """(row, doc_id, line, n, name): every run of n lines that counts, with its first line and its name."""
    lines = _lines(F.col("text"))
    ids = F.transform(lines, lambda x: F.xxhash64(x, F.length(x)))
    words = F.transform(lines, lambda x: F.regexp_count(x, F.lit("[^\\x20\\x09-\\x0D]+")))
    rows = docs.where(F.col("text").isNotNull()).select("row", "doc_id", ids.alias("names1"), words.alias("words"))
    doubled = {1: "names1"}
    for n in range(2, min_lines + 1):  # from the largest doubled run inside, with itself shifted to the end
        h = 1 << (n.bit_length() - 1)
        base, shift, length = (h // 2, h // 2, h) if h == n else (h, n - h, n)
        rows = rows.withColumn(f"names{n}", _paired(doubled[base], shift, length))
        doubled[n] = f"names{n}"
    entries = [_entries(n, 0 if n == min_lines else min_words) for n in range(1, min_lines + 1)]
    size = F.size("names1")
    whole = F.when(F.lit(whole_texts) & (size < min_lines) & F.exists("words", lambda w: w > 0),
                   F.array(F.struct(F.lit(0).alias("line"), size.alias("n"), F.xxhash64("names1", F.lit("whole")).alias("name"))))
    both = F.concat(*entries, F.coalesce(whole, F.array().cast("array<struct<line:int,n:int,name:bigint>>")))
    rows = rows.select("row", "doc_id", both.alias("entries"))
    # outer: an inner explode would have its array computed a second time, by a filter pushed below the steps
    return rows.select("row", "doc_id", F.explode_outer("entries").alias("e")).where(F.col("e").isNotNull()).select("row", "doc_id", "e.*")


def repeated_runs(docs: DataFrame, min_lines: int = 3, min_words: int = 20, whole_texts: bool = True) -> DataFrame:
    """(row, runs): for every row of `docs` that loses lines, its runs as an array of (first, last) line numbers.

    `docs` has row, doc_id and text; lines are numbered from 0.
    """
    starts = _starts(docs, min_lines, min_words, whole_texts)
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row", "line")
    intervals = starts.groupBy("name").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("members"))
    scratch = Scratch(docs.sparkSession, "line-runs")
    intervals = scratch.keep(intervals.where(F.col("members") > 1).select("name", "kept"), "intervals")
    later = prune_by_ids(starts, "name", intervals, "name").join(intervals, "name").where(
        (F.col("row") != F.col("kept.row")) | (F.col("line") != F.col("kept.line")))
    gone = later.select("row", F.explode(F.sequence("line", F.col("line") + F.col("n") - 1)).alias("line"))
    # lines of one run have the same distance to their rank, repeated ones too
    run = F.col("line") - F.dense_rank().over(Window.partitionBy("row").orderBy("line"))
    runs = gone.withColumn("run", run).groupBy("row", "run").agg(F.min("line").alias("first"), F.max("line").alias("last"))
    return scratch.keep(runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs")), "runs")


def drop_repeated_lines(docs: DataFrame, min_lines: int = 3, with_runs: bool = False, min_words: int = 20,
                        whole_texts: bool = True) -> DataFrame:
    """`docs` with the later copies of repeated line runs cut out of `text`; every row stays.

    A run has at least `min_lines` lines, or `min_words` words (stretches without blanks) in fewer lines, or is a whole text of fewer lines
    with a word in it (not with `whole_texts` False, where a later step removes whole copies). Lines are compared exactly; a run may repeat within one text.
    NULL texts stay NULL; a text whose lines all go becomes empty. Repeated rows and rows that share an id are
    texts of their own: the first by (doc_id, row) keeps its lines, NULL ids come last.
    All columns are kept. With `with_runs` a column `runs` holds the cut (first, last) line numbers.
    """
    names = docs.columns
    data = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("d")).select(
        F.monotonically_increasing_id().alias("row"), "d")
    runs = repeated_runs(data.select("row", F.col("d.doc_id").cast("long").alias("doc_id"), F.col("d.text").alias("text")),
                         min_lines, min_words, whole_texts)
    marked = may_hold(data, "row", id_bitmap(runs, "row"), "touched")
    none = F.array().cast("array<struct<first:int,last:int>>")
    same = marked.where(~F.col("touched")).select("d", none.alias("runs"), F.col("d.text").alias("new"))
    cut = marked.where("touched").join(runs, "row", "left").select("d", F.coalesce("runs", none).alias("runs"))
    kept = F.filter(_lines(F.col("d.text")), lambda x, i: ~F.exists("runs", lambda r: i.between(r["first"], r["last"])))
    cut = cut.withColumn("new", F.when(F.size("runs") == 0, F.col("d.text")).otherwise(F.array_join(kept, "\n")))
    both = same.unionByName(cut)
    columns = [F.col("new").alias("text") if c == "text" else F.col(f"d.`{c}`").alias(c) for c in names]
    return both.select(*columns, *(["runs"] if with_runs else []))
