"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

Method. A word enters as its own vector (words frequent in the training sample)
next to the sum of its character-trigram vectors, over the root of their number (all words). Two gated
recurrent layers read a window of words in both directions; attention pools
their states into one logit. The text's score is the largest over all
overlapping windows, so every word of every text is read twice at least.

The network is trained in numpy on a bounded sample of labelled rows
(`train_rows`, chosen by a hash of their ids). Training first gives each window
the label of its text, then refines on the window that scores highest in each
text, which is how texts are scored later. Scoring is a map over all texts:
nothing is shuffled.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import give_back, held_out, text_slices, tidy

MAX_WORD = 64
WORD = re.compile(rf"[^\W\d_]{{1,{MAX_WORD}}}")  # a longer run of letters is read as several words, all of it
WINDOW, STRIDE = 32, 16
AT_ONCE = 1024  # windows scored together: about 15 MB of states
TRIGRAMS = 4096
WORD_DIM = CHAR_DIM = 8
HIDDEN = 8


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


@lru_cache(maxsize=100_000)
def trigrams(word: str) -> list[int]:
    raw = f"^{word}$".encode()
    return [crc32(raw[i:i + 3]) % TRIGRAMS for i in range(len(raw) - 2)]


def window_starts(n: int) -> np.ndarray:
    """The first word of every window over n words; the last window ends with the text."""
    return np.zeros(1, np.int64) if n <= WINDOW else np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


def windows(n: int) -> np.ndarray:
    """Word positions of all windows over n words, -1 for padding."""
    at = window_starts(n)[:, None] + np.arange(WINDOW)
    return np.where(at < n, at, -1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scatter(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """out[at] += values, rows of equal index added up."""
    if len(at):
        order = np.argsort(at, kind="stable")
        ordered = at[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        out[ordered[first]] += np.add.reduceat(values[order], first, axis=0)


@dataclass
class Network:
    """Parameters by name. Word row 0 stands for words outside the vocabulary."""
    vocabulary: dict[str, int]
    base_rate: float
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, vocabulary: dict[str, int], base_rate: float, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, s=0.3: (rng.standard_normal(shape) * s).astype(np.float32)
        x = WORD_DIM + CHAR_DIM
        p = {"word": normal(len(vocabulary) + 1, WORD_DIM, s=0.1), "char": normal(TRIGRAMS, CHAR_DIM, s=0.1),
             "att": normal(2 * HIDDEN, HIDDEN), "att_v": normal(HIDDEN), "out": normal(2 * HIDDEN),
             "out_b": np.array([np.log(max(base_rate, 1e-3) / max(1 - base_rate, 1e-3))], np.float32)}
        for d in "fb":
            p |= {f"w{d}": normal(x, 3 * HIDDEN), f"u{d}": normal(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        p["word"][0] = 0
        return cls(vocabulary, base_rate, p)

    # --- forward ----------------------------------------------------------------------
    def inputs(self, words: list[str], grams_of=trigrams) -> tuple[np.ndarray, tuple]:
        ids = np.array([self.vocabulary.get(w, 0) for w in words], np.int64)
        grams = [grams_of(w) for w in words]
        sizes = np.array([len(g) for g in grams])
        return self.joined(ids, np.array([i for g in grams for i in g], np.int64), sizes)

    def joined(self, ids: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Inputs of words given as their rows, their trigrams one after another, and the number of each one's trigrams."""
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        char = np.add.reduceat(self.p["char"][flat], starts) / np.sqrt(sizes)[:, None]
        return np.hstack([self.p["word"][ids], char]).astype(np.float32), (ids, flat, sizes)

    def gates_in(self, words: list[str]) -> np.ndarray:
        """What each word adds to the gates of both directions: computed once per distinct word, so trigrams need not be remembered."""
        x, _ = self.inputs(words, trigrams.__wrapped__)
        return np.hstack([x @ self.p["wf"] + self.p["cf"], x @ self.p["wb"] + self.p["cb"]])

    def _layer(self, gates: np.ndarray, u: np.ndarray, steps, keep: list | None) -> np.ndarray:
        n, k = len(gates), HIDDEN
        h = np.zeros((n, k), np.float32)
        out = np.zeros((n, WINDOW, k), np.float32)
        for t in steps:
            hu = h @ u
            zr = _sigmoid(gates[:, t, :2 * k] + hu[:, :2 * k])
            z, r = zr[:, :k], zr[:, k:]
            new = np.tanh(gates[:, t, 2 * k:] + r * hu[:, 2 * k:])
            if keep is not None:
                keep.append((t, h, z, r, new, hu[:, 2 * k:]))
            h = new + z * (h - new)
            out[:, t] = h
        return out

    def logits(self, gates: np.ndarray, real: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; gates (windows, WINDOW, 6 HIDDEN), real marks what is no padding."""
        kf, kb = ([], []) if keep is not None else (None, None)
        k = 3 * HIDDEN
        states = np.concatenate([self._layer(gates[:, :, :k], self.p["uf"], range(WINDOW), kf),
                                 self._layer(gates[:, :, k:], self.p["ub"], range(WINDOW - 1, -1, -1), kb)], axis=2)
        hidden = np.tanh(states @ self.p["att"])
        e = np.where(real, hidden @ self.p["att_v"], -1e9)
        a = np.exp(e - e.max(axis=1, keepdims=True))
        a /= a.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,ntk->nk", a, states)
        if keep is not None:
            keep.update(f=kf, b=kb, states=states, hidden=hidden, a=a, pooled=pooled)
        return pooled @ self.p["out"] + self.p["out_b"][0]

    # --- training ---------------------------------------------------------------------
    def gradients(self, words: list[str] | tuple, at: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy; words: as `inputs` or `joined` take them; at: index into words of each window's places, -1 for padding."""
        p, k = self.p, HIDDEN
        x, (ids, flat, sizes) = self.joined(*words) if isinstance(words, tuple) else self.inputs(words)
        both = np.hstack([x @ p["wf"] + p["cf"], x @ p["wb"] + p["cb"]])
        real = at >= 0
        gates = both[at] * real[:, :, None]
        keep: dict = {}
        d = ((_sigmoid(self.logits(gates, real, keep)) - y) / len(y)).astype(np.float32)
        g = {"out": d @ keep["pooled"], "out_b": np.array([d.sum()], np.float32)}
        d_pool = d[:, None] * p["out"]
        states, hidden, a = keep["states"], keep["hidden"], keep["a"]
        d_states = a[:, :, None] * d_pool[:, None, :]
        d_a = np.einsum("ntk,nk->nt", states, d_pool)
        d_e = a * (d_a - (a * d_a).sum(axis=1, keepdims=True))
        g["att_v"] = np.einsum("nt,ntk->k", d_e, hidden)
        d_hidden = d_e[:, :, None] * p["att_v"] * (1 - hidden ** 2)
        g["att"] = np.einsum("nti,ntj->ij", states, d_hidden)
        d_states += d_hidden @ p["att"].T
        d_gates = np.zeros_like(gates)
        for name, part, lo in (("f", d_states[:, :, :k], 0), ("b", d_states[:, :, k:], 3 * k)):
            u, gu = p[f"u{name}"], np.zeros_like(p[f"u{name}"])
            dh = np.zeros((len(at), k), np.float32)
            for t, h, z, r, new, hn in reversed(keep[name]):
                dh = dh + part[:, t]
                d_new = dh * (1 - z) * (1 - new ** 2)
                d_z = dh * (h - new) * z * (1 - z)
                d_r = d_new * hn * r * (1 - r)
                d_hu = np.hstack([d_z, d_r, d_new * r])
                gu += h.T @ d_hu
                d_gates[:, t, lo:lo + 3 * k] = np.hstack([d_z, d_r, d_new])
                dh = dh * z + d_hu @ u.T
            g[f"u{name}"] = gu
        rows = np.zeros_like(both)
        _scatter(rows, at[real], d_gates[real])
        df, db = rows[:, :3 * k], rows[:, 3 * k:]
        g |= {"wf": x.T @ df, "wb": x.T @ db, "cf": df.sum(axis=0), "cb": db.sum(axis=0)}
        dx = df @ p["wf"].T + db @ p["wb"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        _scatter(g["word"], ids, dx[:, :WORD_DIM])
        g["word"][0] = 0
        _scatter(g["char"], flat, np.repeat(dx[:, WORD_DIM:] / np.sqrt(sizes)[:, None], sizes, axis=0))
        return g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.001 * (x * x - self.v[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-7)


class Sample:
    """Texts as numbers of their distinct words: the driver holds four bytes a word, and two a trigram of a distinct word."""

    def __init__(self, texts: Iterable[str | None]):
        index: dict[str, int] = {}
        numbers, sizes = array("i"), []
        for text in texts:
            words = words_of(text)
            numbers.extend([index.setdefault(w, len(index)) for w in words])
            sizes.append(len(words))
        self.distinct = list(index)
        self.numbers, self.sizes = np.array(numbers, np.int32), np.array(sizes, np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        grams = array("H")
        for w in self.distinct:
            grams.extend(trigrams.__wrapped__(w))
        self.grams = np.array(grams, np.uint16)
        self.n_grams = np.array([len(w.encode()) for w in self.distinct], np.int64)  # ^ and $ are bytes of their own
        self.gram_at = np.cumsum(self.n_grams) - self.n_grams

    def words(self, text: int) -> list[str]:
        return [self.distinct[i] for i in self.numbers[self.first[text]:self.first[text] + self.sizes[text]].tolist()]

    def frequent(self, least: int, most: int) -> list[int]:
        """The words of `least` texts or more, those of most texts first, at most so many."""
        texts = np.zeros(len(self.distinct), np.int64)
        for a, n in zip(self.first.tolist(), self.sizes.tolist(), strict=True):
            texts[np.unique(self.numbers[a:a + n])] += 1
        return sorted(np.flatnonzero(texts >= least).tolist(), key=lambda i: (-texts[i], self.distinct[i]))[:most]

    def batch(self, text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words of the windows that begin at word `start` of each text, in their order, and the windows as indexes into them."""
        place = start[:, None] + np.arange(WINDOW)
        real = place < self.sizes[text][:, None]
        found, first, inverse = np.unique(self.numbers[(self.first[text][:, None] + place)[real]], return_index=True, return_inverse=True)
        order = np.argsort(first)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = np.full(place.shape, -1, np.int64)
        at[real] = rank[inverse.reshape(-1)]
        return found[order], at

    def trigrams_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The trigrams of some words one after another, and the number of each one's."""
        sizes = self.n_grams[words]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.grams[np.repeat(self.gram_at[words], sizes) + within].astype(np.int64), sizes


def train(texts: Iterable[str | None], labels: list[int], vocabulary_size: int = 20_000, per_text: int = 8, steps: int = 400,
          refine: int = 2, batch: int = 256, rate: float = 0.01, seed: int = 5) -> Network:
    """A network from labelled texts; texts without a word count for the base rate only.

    The first phase takes at least `steps` steps and one pass over `per_text` windows of every text, each of
    the `refine` rounds at least a tenth of that and one pass over the texts.
    """
    y_all = np.array(labels, np.float32)
    base = float(y_all.mean()) if len(y_all) else 0.0
    sample = Sample(texts)
    full = np.flatnonzero(sample.sizes)
    y_all = y_all[full]
    frequent = sample.frequent(3, vocabulary_size)
    row = np.zeros(len(sample.distinct), np.int64)
    row[frequent] = np.arange(1, len(frequent) + 1)
    net = Network.new({sample.distinct[i]: n + 1 for n, i in enumerate(frequent)}, base, seed)
    if not len(full) or y_all.min() == y_all.max():
        return net
    rng = np.random.default_rng(seed)
    adam = Adam(net.p, rate)

    def learn(places, least: int) -> None:
        done = 0
        while done < max(1, least):
            text, start = places()
            order = rng.permutation(len(text))
            for a in range(0, len(order), batch):
                part = order[a:a + batch]
                words, at = sample.batch(full[text[part]], start[part])
                adam.step(net.gradients((row[words], *sample.trigrams_of(words)), at, y_all[text[part]]))
                done += 1

    def some() -> tuple[np.ndarray, np.ndarray]:
        starts = [window_starts(n) for n in sample.sizes[full].tolist()]
        starts = [s[rng.choice(len(s), min(per_text, len(s)), replace=False)] for s in starts]
        return np.repeat(np.arange(len(full)), [len(s) for s in starts]), np.concatenate(starts)

    learn(some, steps)
    scorer = Scorer(net)
    for _ in range(refine):
        adam.rate = rate / 3
        scorer.forget()
        best = np.zeros(len(full), np.int64)
        for a in range(0, len(full), 64):
            part = full[a:a + 64].tolist()
            logits = scorer.window_logits([sample.words(i) for i in part], 64)
            best[a:a + 64] = [window_starts(int(sample.sizes[i]))[np.argmax(z)] for i, z in zip(part, logits, strict=True)]
        learn(lambda: (np.arange(len(full)), best), steps // 10)  # noqa: B023
    return net


class Scorer:
    """Scores texts; what a distinct word adds to the gates is remembered for up to `limit` words."""

    def __init__(self, net: Network, limit: int = 150_000):
        self.net, self.limit = net, limit
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.gates = np.zeros((1024, 6 * HIDDEN), np.float32)  # row 0 is padding

    def index(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if new:
            if len(self.rows) + len(new) > self.limit and self.rows:
                self.forget()
                return self.index(words)
            start = len(self.rows) + 1
            while start + len(new) > len(self.gates):
                self.gates = np.vstack([self.gates, np.zeros_like(self.gates)])
            self.gates[start:start + len(new)] = self.net.gates_in(new)
            self.rows.update(zip(new, range(start, start + len(new)), strict=True))
        return np.array([self.rows[w] for w in words], np.int64)

    def window_logits(self, texts: list[list[str]], chunk: int = 64) -> Iterator[np.ndarray]:
        """The logits of the windows of each text, given as its words (one at least)."""
        for a in range(0, len(texts), chunk):
            part = texts[a:a + chunk]
            rows = np.append(self.index([w for words in part for w in words]), 0)
            shift, places = 0, []
            for words in part:
                at = windows(len(words))
                places.append(np.where(at >= 0, at + shift, len(rows) - 1))
                shift += len(words)
            at = np.concatenate(places)
            logits = np.concatenate([self.net.logits(self.gates[rows[at[i:i + AT_ONCE]]], at[i:i + AT_ONCE] < len(rows) - 1)
                                     for i in range(0, len(at), AT_ONCE)])
            yield from np.split(logits, np.cumsum([len(p) for p in places])[:-1])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The largest window score of each text; the training base rate for a text without a word."""
        words = [words_of(t) for t in texts]
        out = np.full(len(texts), min(self.net.base_rate, 0.49))
        full = [i for i, w in enumerate(words) if w]
        out[full] = [_sigmoid(z.max()) for z in self.window_logits([words[i] for i in full], 256)]
        return out


def _score_batches(shared, text_at: int):
    @tidy(trigrams.cache_clear)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for a, b in text_slices(batch.column(text_at), 512 << 10):
                part = batch.slice(a, b - a)
                s = scorer.scores(part.column(text_at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())],
                                                 names=[*part.schema.names, "score"])
    return run


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = 4000, seed: int = 5) -> Network:
    """Train on at most `train_rows` labelled rows outside the evaluation fold, chosen by a hash of the id.

    Ids with NULL or contradicting labels, and repeated ids in `docs`, are resolved by taking
    the largest label and the smallest text. Only the chosen rows come to the driver.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most train_rows rows
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
            .orderBy("doc_id").toArrow())
    net = train((t.as_py() for t in rows.column("text")), rows.column("toxic").to_pylist(), seed=seed)
    del rows
    give_back(trigrams.cache_clear)  # the driver's process goes on
    return net


def score(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """`docs` with a column `score` (0 to 1); a column of that name is replaced. NULL reads as empty."""
    df = docs.drop("score")
    shared = df.sparkSession.sparkContext.broadcast(net)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_score_batches(shared, df.columns.index(text)), f"{fields}, score double")


def rate_documents(docs: DataFrame, labels: DataFrame, train_rows: int = 4000) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score and predicted (1 from a score of 0.5)."""
    net = learn(docs, labels, train_rows)
    out = score(docs.select("doc_id", "text"), net)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, train_rows: int = 4000) -> DataFrame:
    """The rows of `docs`, all columns, whose score stays under 0.5."""
    net = learn(docs, labels, train_rows)
    plain = score(docs.withColumnRenamed("score", "__score") if "score" in docs.columns else docs, net)
    kept = plain.where(F.col("score") < 0.5).drop("score")
    return kept.withColumnRenamed("__score", "score").select(*docs.columns)
