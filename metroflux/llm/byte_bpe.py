"""Byte-level BPE with the tiktoken library over a local rank file.

Method. The library cuts a text by a pattern and merges the bytes of every match on its own. Texts of
ordinary length go to it whole. A long text is cut first, at places where a match of the pattern ends
whatever surrounds them, so the parts encode independently and their ids are concatenated:

* before white space that follows anything else (no match runs on into white space);
* between an ASCII letter and a digit, and between ASCII punctuation and a letter or digit, but for the
  apostrophe, which may open a contraction.

The pattern looks ahead inside runs of white space, one step of the regex engine's stack per character, and the
engine gives up on very long runs. Such a run is one match by itself (without its last character if more
text follows), so it is cut out here and its bytes are merged as one piece.

Decoding joins the raw bytes of the ids, so a token that holds half a character loses nothing.
Rows never meet: nothing is shuffled, and a task holds the ids of one part of one text at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from metroflux.llm.common import text_slices

# White space as the library's regex engine has it (the White_Space property): fixed values.
_BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SAFE = re.compile(f"(?<=[^{_BLANKS}])(?=[{_BLANKS}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
                   r"|(?<=[!-&(-/:-@\[-`{-~])(?=[A-Za-z0-9])")


class ByteBpe:
    """The library's encoder for one rank file (lines of a base64 token and its rank) and one pattern.

    Texts of more than `part` characters are cut at safe places; runs of white space of `run` characters or more
    are pieces of their own there.
    """

    def __init__(self, path: str, pattern: str, part: int = 1 << 15, run: int = 1 << 12):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self._library = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._one_piece = tiktoken.Encoding(path, pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self._part = part
        self._run = re.compile(f"[{_BLANKS}]{{{run},}}")

    def parts(self, text: str) -> Iterator[tuple[int, int, bool]]:
        """(start, end, one piece) of the parts that a text is encoded in; only long texts have several."""
        n = len(text)
        if n <= self._part:
            if n:
                yield 0, n, False
            return
        at = 0
        for run in self._run.finditer(text):
            yield from self._cut(text, at, run.start())
            at = n if run.end() == n else run.end() - 1
            yield run.start(), at, True
        yield from self._cut(text, at, n)

    def _cut(self, text: str, start: int, end: int) -> Iterator[tuple[int, int, bool]]:
        while end - start > self._part:
            safe = _SAFE.search(text, start + self._part, end)
            if safe is None:
                break
            yield start, safe.start(), False
            start = safe.start()
        if start < end:
            yield start, end, False

    def encode_parts(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, part by part."""
        for a, b, one in self.parts(text):
            yield (self._one_piece if one else self._library).encode_ordinary(text[a:b])

    def encode(self, text: str) -> list[int]:
        return [i for part in self.encode_parts(text) for i in part]

    def decode(self, ids) -> bytes:
        """The raw bytes of the ids; an id that the file does not hold is an error."""
        return self._library.decode_bytes(ids)


def _append(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _encode_batches(path: str, pattern: str, text_at: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in batches:
            for a, b in text_slices(batch.column(text_at)):
                part = batch.slice(a, b - a)
                ids = [np.array(bpe.encode(t), np.int32) if t else np.zeros(0, np.int32) for t in part.column(text_at).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                yield _append(part, name, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))))
    return run


def _decode_batches(path: str, pattern: str, ids_at: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                texts = [None if ids is None else bpe.decode(ids) for ids in part.column(ids_at).to_pylist()]
                yield _append(part, name, pa.array(texts, pa.binary()))
    return run


def _digest_batches(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for text in batch.column(1):
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for ids in bpe.encode_parts(text.as_py() or ""):
                    of_ids.update(((" " if n else "") + " ".join(map(str, ids))).encode())
                    of_text.update(bpe.decode(ids))
                    n += len(ids)
                counts.append(n)
                id_digests.append(of_ids.hexdigest())
                text_digests.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """`df` with an array column `name`: the ids of every whole text.

    NULL and empty texts have no ids. Strings that look like special tokens are ordinary text. Texts of any
    length are read whole. Every row is encoded by itself, repeated rows and ids too; an empty table
    gives no rows. All columns of `df` stay; one that is already called `name` is replaced, so choose
    another `name` to keep it.
    """
    df = df.drop(name)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(_encode_batches(path, pattern, df.columns.index(text), name), schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`df` with a binary column `name`: the raw bytes of the ids (NULL ids give NULL, no ids give no bytes).

    The bytes need not be UTF-8: ids may end inside a character. An unknown or NULL id is an error. All columns stay; one
    that is already called `name` is replaced.
    """
    df = df.drop(name)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())])
    return df.mapInArrow(_decode_batches(path, pattern, df.columns.index(ids), name), schema)


def encode_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, and SHA-256 of the ids and of the bytes they decode to.

    Encoding, decoding and hashing are one pass, and the ids of a long text never exist together.
    NULL texts count as empty; rows with NULL or repeated ids are rows of their own; an empty table gives no
    rows. Other columns are not read.
    """
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        _digest_batches(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
