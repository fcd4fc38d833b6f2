"""Word and shingle hashes of whole texts, computed on the UTF-8 bytes of many texts at once.

Words are the maximal stretches of bytes that are not blanks (0x20, 0x09-0x0D);
A-Z is folded to a-z. A word's hash is a polynomial over random 64-bit letters,
finished with a bit mixer, so equal words have equal hashes in every task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_SEED = 20240607


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    table = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
    table[65:91] = table[97:123]
    return table


@lru_cache(maxsize=1)
def _blank() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


BLOCK = 1 << 16  # bytes hashed at once
_POWERS: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse; those of some blocks are kept, more are made for the call."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    made = []
    for base in (_BASE, U(pow(int(_BASE), -1, 2**64))):
        steps = np.full(max(n, 2 * BLOCK), base, U)
        steps[0] = U(1)
        made.append(np.multiply.accumulate(steps))
    if n <= 2 * BLOCK:
        _POWERS[:] = made
    return made[0], made[1]


@lru_cache(maxsize=1)
def plain() -> np.ndarray:
    """The bytes of plain words: ASCII letters, digits and everything beyond ASCII."""
    table = np.zeros(256, bool)
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[lo:hi] = True
    return table


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of its first word for every text (one more at the end).

    `table` says which bytes belong to words; by default all that are not blanks.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = (~_blank() if table is None else table)[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every word, made for those that begin in the same BLOCK of bytes together, so a long text needs no long arrays of numbers."""
    out = np.zeros(len(starts), U)
    edges = np.searchsorted(starts, np.arange(0, len(data) + BLOCK, BLOCK)).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        if a < b:
            lo, hi = int(starts[a]), int(ends[b - 1])
            power, inverse = powers(hi - lo)
            total = np.zeros(hi - lo + 1, U)
            np.cumsum(letters()[data[lo:hi]] * power[:hi - lo], out=total[1:])
            out[a:b] = mix((total[ends[a:b] - lo] - total[starts[a:b] - lo]) * inverse[starts[a:b] - lo])
    return out


def shingles(hashes: np.ndarray, firsts: np.ndarray, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles.

    With fewer than k words the whole sequence is the one shingle; without words there is none.
    """
    weights = mix(np.arange(1, k + 2, dtype=U) * _BASE) | U(1)
    n = len(hashes)
    if n >= k:
        grams = np.zeros(n - k + 1, U)
        for j in range(k):
            grams += hashes[j:n - k + 1 + j] * weights[j]
        grams = mix(grams)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        m = b - a
        if m >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif m:
            out.append(mix((hashes[a:b] * weights[:m]).sum(keepdims=True, dtype=U) + U(m) * weights[k]))
        else:
            out.append(hashes[:0])
    return out
