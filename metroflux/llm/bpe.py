"""Byte-pair encoding and decoding with forced-boundary splitting.

A vocabulary file of the `tokenizers` JSON kind (BPE with an end-of-word
suffix, byte-level alphabet, lower-casing normaliser) is read, never trained.

Method. No merge can build a token that is not in the vocabulary. So where two
neighbouring bytes never stand side by side inside any vocabulary token, no
merge can cross, and the cut there is certain. A pre-token is cut at all such
places, the fragments are encoded independently of each other (and remembered,
since the same fragments recur in many words), and the ids are concatenated.

Rows never meet, so encoding and decoding need no shuffle.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from metroflux.llm.common import text_slices, tidy

# Characters below this need no table of the library: Python's own case and letter data agree with it there.
_PLAIN_END = 0x180
MEMO_BYTES = 48 << 20  # what a task remembers of pre-tokens
_LONG = 64  # symbols from which a fragment is merged with a heap


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def _char_class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_PLAIN_END) if unicodedata.category(chr(c))[0] == kind)


class Memo(dict):
    """A dict that computes what is missing. Its entries take at most `limit` bytes (about): when they take half of
    that they become the older half, which is dropped at the next such time but for what was asked for meanwhile.
    """

    ENTRY = 250  # bytes of an entry besides the characters of its key and the items of its value

    def __init__(self, compute, limit: int, items=len):
        super().__init__()
        self._compute, self._limit, self._items = compute, limit // 2, items
        self._held, self._older = 0, {}

    def __missing__(self, key):
        if (value := self._older.pop(key, None)) is None:
            value = self._compute(key)
        if len(key) <= 256:  # a longer one seldom comes back
            size = self.ENTRY + len(key) + 8 * self._items(value)
            if self._held + size > self._limit:
                self._older = dict(self)
                self.clear()
                self._held = 0
            self[key] = value
            self._held += size
        return value


class BpeEncoder:
    def __init__(self, path: str, memo_bytes: int = 16 << 20):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback"):
            raise ValueError("a plain byte-level BPE vocabulary is expected")
        self.path = path
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.rank: dict[tuple[str, str], int] = {}
        for rank, pair in enumerate(model["merges"]):
            self.rank.setdefault(tuple(pair), rank)
        self.merged = [a + b for a, b in model["merges"]]
        self.alphabet = _byte_alphabet()
        self._to_alphabet = dict(enumerate(self.alphabet))
        self._byte_of = {c: b for b, c in enumerate(self.alphabet)}
        # byte pairs that stand side by side inside some token; every other pair is a certain cut
        self.joined: set[tuple[str, str]] = set()
        for token in self.vocab:
            body = token.removesuffix(self.suffix) if self.suffix else token
            self.joined.update(zip(body, body[1:], strict=False))
        letters, numbers = _char_class("L"), _char_class("N")
        self._split = re.compile(f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^\\t-\\r \\x85\\xa0{letters}{numbers}]+")
        self._beyond = re.compile(f"[^\\x00-įı-{chr(_PLAIN_END - 1)}]")
        self._specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self._library = None
        self.fragments = Memo(self._merge_fragment, memo_bytes)

    # --- text to pre-tokens ---------------------------------------------------------
    def pretokens(self, text: str) -> list[str]:
        """Normalised pre-tokens of a text without special strings."""
        if self._beyond.search(text):
            return self._library_pretokens(text)
        return self._split.findall(text.lower())

    def _library_pretokens(self, text: str) -> list[str]:
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.path)
        pieces = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(self._byte_of[c] for c in p).decode() for p, _ in pieces]

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Plain stretches of a text (with None) and special strings (with their id), in order."""
        at = 0
        for m in self._specials.finditer(text) if self._specials else ():
            if m.start() > at:
                yield text[at:m.start()], None
            yield m.group(), self.special[m.group()]
            at = m.end()
        if at < len(text):
            yield text[at:], None

    # --- pre-tokens to ids ------------------------------------------------------------
    def cut(self, symbols: str) -> list[str]:
        """The fragments of a pre-token in the byte alphabet: pieces between certain cuts."""
        joined = self.joined
        if joined.issuperset(pairwise(symbols)):
            return [symbols]
        edges = [i for i, pair in enumerate(pairwise(symbols), 1) if pair not in joined]
        return [symbols[a:b] for a, b in zip([0, *edges], [*edges, len(symbols)], strict=True)]

    def encode_pretoken(self, pretoken: str) -> tuple[int, ...]:
        symbols = pretoken.encode().decode("latin-1").translate(self._to_alphabet)
        fragments = self.cut(symbols)
        if len(fragments) == 1:
            return self._merge_fragment(symbols + self.suffix)
        out = ()
        for f in fragments[:-1]:
            out += self.fragments[f]
        return out + self.fragments[fragments[-1] + self.suffix]

    def _merge_fragment(self, fragment: str) -> tuple[int, ...]:
        body = fragment.removesuffix(self.suffix) if self.suffix else fragment
        symbols = list(body)
        if len(body) != len(fragment):
            symbols[-1] += self.suffix
        symbols = self._merge_long(symbols) if len(symbols) > _LONG else self._merge_short(symbols)
        return tuple([self.vocab[s] for s in symbols])

    def _merge_short(self, symbols: list[str]) -> list[str]:
        rank, never = self.rank.get, 1 << 60
        ranks = [rank(p, never) for p in pairwise(symbols)]
        while ranks and (best := min(ranks)) < never:
            i = ranks.index(best)
            symbols[i] = self.merged[best]
            del symbols[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), never)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), never)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.rank.get((symbols[i], symbols[j]))) is not None:
                heapq.heappush(queue, (rank, i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = a + b, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]

    def decode(self, ids) -> str:
        """Tokens of the ids joined by blanks, special ones included (the vocabulary file names no decoder)."""
        return " ".join(map(self.token_of.__getitem__, ids))


@lru_cache(maxsize=1)
def encoder(path: str) -> BpeEncoder:
    """The encoder of a worker process; another vocabulary replaces it."""
    return BpeEncoder(path)


class _Packer:
    """Packed ids of whole texts, with a memo over pre-tokens that lives as long as the task."""

    def __init__(self, path: str, memo_bytes: int):
        self.enc = enc = encoder(path)
        self._known = Memo(lambda p: np.array(enc.encode_pretoken(p), np.int32).tobytes(), memo_bytes).__getitem__
        self._specials = {i: np.array([i], np.int32).tobytes() for i in enc.special.values()}

    def __call__(self, text: str | None) -> bytes:
        return b"".join([self._specials[special] if special is not None else b"".join(map(self._known, self.enc.pretokens(piece)))
                         for piece, special in self.enc.parts(text)]) if text else b""


class _Writer:
    """The ids of a whole text and the text they decode to, both as written, with a memo over pre-tokens of what each adds."""

    def __init__(self, path: str, memo_bytes: int):
        self.enc = enc = encoder(path)
        self._number = {i: str(i) for i in enc.token_of}.__getitem__
        self._known = Memo(lambda p: self._write(enc.encode_pretoken(p)), memo_bytes, lambda v: (len(v[0]) + len(v[1])) // 8 + 3).__getitem__
        self._specials = {i: self._write([i]) for i in enc.special.values()}

    def _write(self, ids) -> tuple[str, str]:
        return " ".join(map(self._number, ids)), self.enc.decode(ids)

    def __call__(self, text: str | None) -> tuple[str, str]:
        written = []
        for piece, special in self.enc.parts(text) if text else ():
            if special is not None:
                written.append(self._specials[special])
            else:
                written.extend(map(self._known, self.enc.pretokens(piece)))
        return " ".join([ids for ids, _ in written]), " ".join([tokens for _, tokens in written])


def _forget() -> None:
    encoder.cache_clear()


def _encode_batches(path: str, text_at: int, memo_bytes: int):
    @tidy(_forget)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _Packer(path, memo_bytes)
        for batch in batches:
            for a, b in text_slices(batch.column(text_at), 2 << 20):
                part = batch.slice(a, b - a)
                values = [pack(text) for text in part.column(text_at).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(v) // 4 for v in values])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(values), np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, "ids"])
    return run


def _digest_batches(path: str, memo_bytes: int):
    """Encode, decode and hash in one pass, a text at a time: neither ids nor decoded texts leave the task."""
    @tidy(_forget)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = _Writer(path, memo_bytes)
        for batch in batches:
            sizes, id_digests, text_digests = [], [], []
            for text in batch.column(1):
                ids, decoded = write(text.as_py())
                sizes.append(ids.count(" ") + 1 if ids else 0)
                id_digests.append(sha256(ids.encode()).hexdigest())
                text_digests.append(sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _decode_batches(path: str, ids_at: int, name: str):
    @tidy(_forget)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        tokens = pa.array([enc.token_of.get(i) for i in range(max(enc.token_of) + 1)], pa.string())
        for batch in batches:
            column = batch.column(ids_at)
            step = 256  # decoded texts are several times as large as their ids
            for a in range(0, batch.num_rows, step):
                part, ids = batch.slice(a, step), column.slice(a, step)
                sizes = pc.list_value_length(ids).fill_null(0).to_numpy()
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                texts = pc.binary_join(pa.ListArray.from_arrays(offsets, tokens.take(ids.flatten())), " ")
                texts = pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), texts)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, name])
    return run


def encode(df: DataFrame, path: str, text: str = "text", memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """`df` with a column `ids`: the token ids of every whole text.

    NULL and empty texts have no ids. Special strings inside a text become
    their special token, as the library does by default; none are added, and
    nothing is cut or padded. All columns of `df` are kept; a column that is
    already called `ids` is replaced.
    """
    df = df.drop("ids")
    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(_encode_batches(path, df.columns.index(text), memo_bytes), schema)


def decode(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`df` with a column `name`: the text that the ids decode to (NULL ids give NULL, no ids an empty text)."""
    df = df.drop(name)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])
    return df.mapInArrow(_decode_batches(path, df.columns.index(ids), name), schema)


def encode_digest(docs: DataFrame, path: str, memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, and SHA-256 of the ids and of the text they decode to.

    NULL texts count as empty. Texts of any length are read whole, one at a time. Repeated rows and ids are rows
    of their own; an empty table gives no rows. Other columns are not read.
    """
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        _digest_batches(path, memo_bytes), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
