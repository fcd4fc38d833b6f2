"""Secret scan: candidate strings in text, and a random forest that removes false positives; DataFrame functions only.

Candidates are stretches of at least `MIN_LENGTH` key-like characters with a digit or a change from lower to upper
case among them, keys with a known prefix (dots included, as in signed tokens), and whatever of at least `SHORT` characters is
assigned to a credential's name. A name and its value (NAME=value) are separate stretches. Each gets features of five kinds: its length; the transitions between character classes in it;
how much of it the dictionary covers (the corpus' most frequent words, a table of bounded size);
whether it is part of a path or an address; and the words beside it. The forest
is trained on labelled findings, a bounded sample of them, and scores every candidate.

The given tables hold no labelled findings, so the query labels by written evidence (`label_by_rule`), both ways;
findings without evidence are not taught, only scored.
`scan` takes any table of labels instead.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import Scratch

MIN_LENGTH = 16
SHORT = 6
KEY = "[A-Za-z0-9+/_-]"
PREFIX = "(?:AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|xox[abeoprs]-|[srp]k-|[srp]k_live_|SG[.]|hf_|npm_|eyJ)"
NAMES = ["pwd", "token", "secret", "bearer", "passwd", "apikey", "api_key", "api-key", "api key", "password", "passwort", "auth_key",
         "accesskey", "secretkey", "access_key", "access-key", "access key", "secret_key", "secret-key", "secret key", "passphrase",
         "credential", "credentials", "private_key", "private-key", "auth"]


def _assigned() -> str:
    """Right after a credential's name, = or :, and what quotes and blanks are there; every lookbehind has a fixed width."""
    signs = [a + b + "[=:]" + c + d for a in ("", "[\"']") for b in ("", " ") for c in ("", " ") for d in ("", "[\"']")]
    by_width = {len(x): [y for y in NAMES if len(y) == len(x)] for x in NAMES}
    behind = "|".join(f"(?<=(?:{'|'.join(names)}){sign})" for names in by_width.values() for sign in signs)
    return f"(?:(?<=[=:])|(?<=[=:][\"' ])|(?<=[=:] [\"']))(?i:{behind})"


_PADDING = "(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
CANDIDATE = (f"(?:{_assigned()}[^\\s\"'`,;&<>(){{}}\\[\\]]{{{SHORT},}}"
             f"|(?<![A-Za-z0-9+/_-]){PREFIX}[A-Za-z0-9._+/-]{{15,}}{KEY}{_PADDING}"
             f"|(?<!{KEY})(?={KEY}{{{MIN_LENGTH}}})(?=[A-Za-z+/_-]*(?:[0-9]|[a-z][A-Z])){KEY}{{{MIN_LENGTH},}}{_PADDING})")
MAYBE = f"[=:]|[A-Za-z0-9._+/-]{{{MIN_LENGTH}}}"  # every line with a candidate has this
BESIDE = 200
CREDENTIAL = "(?i)(token|secret|passw|pwd|api.?key|auth|credential|access.?key|private.?key|bearer)"
HASH_BEFORE = "(?i)\\b(commit|sha-?[0-9]*|md5|digest|checksum|hash|rev|revision|uuid|guid|isbn|doi)\\W{0,3}$"
FEATURES = ["f_length", "f_runs", "f_run_share", "f_digit_share", "f_upper_share", "f_lower_share", "f_sign_share",
            "f_hex", "f_dictionary", "f_slashes", "f_address", "f_credential", "f_assigned", "f_quoted", "f_words_before",
            "f_distinct", "f_prefix", "f_bearer", "f_hash_before", "f_name"]


def _share(pattern: str, of: Column) -> Column:
    return F.length(F.regexp_replace(of, pattern, "")) / F.length(of)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, line, start, finding, before, after): every candidate with its line beside it, BESIDE characters each way.

    `line` counts from 0, `start` counts the characters of the line before the finding.
    """
    lines = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("line", "body"))
    lines = lines.where(F.col("body").rlike(MAYBE)).where(F.col("body").rlike(CANDIDATE))
    # the stretches between the findings of a line say where each finding starts
    found = F.regexp_extract_all("body", F.lit(CANDIDATE), F.lit(0))
    gaps = F.split("body", CANDIDATE, -1)
    each = lines.select("doc_id", "line", "body", found.alias("found"), gaps.alias("gaps"))
    each = each.select("doc_id", "line", "body", "gaps", F.posexplode("found").alias("i", "finding"), "found")
    start = F.aggregate(F.slice("gaps", 1, F.col("i") + 1), F.lit(0), lambda n, g: n + F.length(g)) + F.aggregate(
        F.slice("found", 1, F.col("i")), F.lit(0), lambda n, g: n + F.length(g))
    each = each.select("doc_id", "line", start.cast("int").alias("start"), "finding", "body")
    head = F.greatest(F.col("start") - BESIDE, F.lit(0))
    return each.select("doc_id", "line", "start", "finding", F.substring("body", head + 1, F.col("start") - head).alias("before"),
                       F.substring("body", F.col("start") + F.length("finding") + 1, F.lit(BESIDE)).alias("after"))


def dictionary(docs: DataFrame, size: int = 20_000, least: int = 3, longest: int = 32) -> DataFrame:
    """The most frequent words of the whole corpus: at most `size` rows of `least` to `longest` letters."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^\\p{L}]+")).alias("word"))
    counts = words.where(F.length("word").between(least, longest)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(size).select("word")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """`found` with the columns of FEATURES; `words` is the dictionary (bounded, so it is broadcast)."""
    x, before, after = F.col("finding"), F.col("before"), F.col("after")
    numbered = found.withColumn("finding_no", F.xxhash64("doc_id", "line", "start", "finding"))
    parts = numbered.select("finding", F.explode(F.regexp_extract_all(F.lower("finding"), F.lit("[a-z]{3,32}"), F.lit(0))).alias("word"))
    covered = parts.distinct().join(F.broadcast(words), "word").groupBy("finding").agg(F.sum(F.length("word")).alias("covered"))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "[0-9]+", "0"), "[a-z]+", "a"), "[A-Z]+", "B")
    tail = F.substring_index(before, " ", -1)
    last_words = F.slice(F.split(F.trim(before), "\\s+"), -3, 3)
    near = F.when(F.size(F.split(F.trim(before), "\\s+")) > 3, F.concat_ws(" ", last_words)).otherwise(before)
    runs = F.length(classes)
    out = numbered.join(covered, "finding", "left").withColumns({
        "f_length": F.length(x), "f_runs": runs, "f_run_share": runs / F.length(x),
        "f_digit_share": 1 - _share("[0-9]", x), "f_upper_share": 1 - _share("[A-Z]", x),
        "f_lower_share": 1 - _share("[a-z]", x), "f_sign_share": _share("[A-Za-z0-9]", x),
        "f_hex": x.rlike("^([0-9a-f]+|[0-9A-F]+)$") & x.rlike("[A-Fa-f]"),
        "f_dictionary": F.least(F.coalesce("covered", F.lit(0)) / F.length(x), F.lit(1.0)),
        "f_slashes": F.length(x) - F.length(F.replace(x, F.lit("/"), F.lit(""))) + F.length(tail) - F.length(F.replace(tail, F.lit("/"), F.lit(""))),
        "f_address": tail.rlike("[@:/.]$") | after.rlike("^[@.][A-Za-z0-9]"),
        "f_credential": near.rlike(CREDENTIAL), "f_assigned": before.rlike("[=:]\\s*[\"']?$"),
        "f_quoted": before.rlike("[\"'`]$") & after.rlike("^[\"'`]"),
        "f_words_before": F.size(F.split(F.trim(near), "\\s+")),
        "f_distinct": F.size(F.array_distinct(F.split(x, ""))), "f_prefix": x.rlike(f"^{PREFIX}"),
        "f_bearer": before.rlike("(?i)bearer\\s+$"), "f_hash_before": before.rlike(HASH_BEFORE), "f_name": after.rlike("^ ?=")})
    return out.withColumns({f: F.col(f).cast("double") for f in FEATURES}).drop("covered")


def label_by_rule(found: DataFrame) -> DataFrame:
    """(finding_no, label): 1 and 0 where there is evidence, else NULL.

    For a secret: a known prefix; a value that mixes character classes and is no dictionary word, assigned to a
    credential's name, quoted or not; what follows `bearer`. Against one, away from credentials' names: no
    letters, paths and addresses, hashes named as such, mostly dictionary words, names that are assigned to.
    """
    c = {f: F.col(f) for f in FEATURES}
    mixed = (c["f_runs"] >= 2) & (c["f_distinct"] >= 5) & (c["f_dictionary"] < 0.5) & (c["f_digit_share"] < 1)
    named = (c["f_credential"] == 1) & (c["f_assigned"] == 1)
    key = (c["f_prefix"] == 1) & (c["f_distinct"] >= 8)
    secret = key | (mixed & (named | (c["f_bearer"] == 1)))
    plain = (c["f_digit_share"] + c["f_sign_share"] >= 1) | (c["f_slashes"] >= 2) | (c["f_address"] == 1) | (
        c["f_hash_before"] == 1) | (c["f_dictionary"] >= 0.5)
    label = F.when(c["f_name"] == 1, 0.0).when(secret, 1.0).when(plain & (c["f_credential"] == 0), 0.0)
    return found.select("finding_no", label.alias("label"))


def scan(docs: DataFrame, labels: DataFrame | None = None, train_rows: int = 20_000, trees: int = 20, depth: int = 5,
         seed: int = 3) -> DataFrame:
    """Every candidate of `docs` (doc_id, text): doc_id, line, start, finding, score, is_secret (score from 0.5).

    `labels` is (finding_no, label) with finding_no = xxhash64(doc_id, line, start, finding); without it
    `label_by_rule` labels. At most `train_rows` findings, chosen by a hash, train the forest; all are
    scored. With labels of one kind only, every score is that label (0 without any); without findings there are no rows. NULL and
    empty texts hold no candidates. Repeated rows give their findings repeatedly.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    words = scratch.keep(dictionary(docs), "dictionary")
    found = scratch.keep(candidates(docs), "candidates")  # the features need them twice, the patterns run once
    found = scratch.keep(with_features(found, words), "findings")
    known = label_by_rule(found) if labels is None else labels
    known = known.where(F.col("label").isNotNull()).groupBy("finding_no").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("finding_no"), "finding_no").limit(train_rows)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # at most `train_rows` rows: held in memory, not in a file of its own for every few of them
    train = found.dropDuplicates(["finding_no"]).join(F.broadcast(chosen), "finding_no").select(
        *FEATURES, F.col("label").cast("double").alias("label")).coalesce(8).persist()
    span = train.agg(F.min("label").alias("lo"), F.max("label").alias("hi")).first()
    plain = ["doc_id", "line", "start", "finding"]
    if span.lo == span.hi:
        scored = found.select(*plain, F.lit(span.hi or 0.0).cast("double").alias("score"))
    else:
        model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(assembler.transform(train))
        out = model.transform(assembler.transform(found.select(*plain, *FEATURES)))
        scored = out.select(*plain, vector_to_array("probability")[1].alias("score"))
    train.unpersist()
    return scored.withColumn("is_secret", F.col("score") >= 0.5)
