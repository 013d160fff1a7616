"""Words of a batch of texts as numpy arrays, used inside Python tasks.

A word is a run of ASCII letters (lower-cased), ASCII digits and characters beyond
ASCII. As every byte of a character beyond ASCII is above 0x7F, words can be found on
UTF-8 bytes. Texts are worked off in pieces of bounded bytes, so memory does not depend
on the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19
U64 = np.uint64

_LOWER = np.zeros(256, np.uint8)  # 0: no word character
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _LOWER[_b] = _b
for _b in range(0x41, 0x5B):
    _LOWER[_b] = _b + 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95  # odd, hence invertible modulo 2**64


class _Cache(dict):
    """A dict that travels empty."""

    def __reduce__(self):
        return _Cache, ()


_POWERS = _Cache()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n - 1."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, PIECE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, U64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=U64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


@dataclass
class Words:
    """Words of consecutive texts: word i spans ``data[start[i]:end[i]]`` (lower-cased bytes);
    text t has the words ``first[t]`` to ``first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def text_of(self) -> np.ndarray:
        """Text number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the texts' bounds in them; a null text has none."""
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, bounds


def pieces(bounds: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together (a longer text comes alone)."""
    n, at = len(bounds) - 1, 0
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    base = int(bounds[0])
    data = _LOWER[data[base:int(bounds[-1])]]
    n, bounds = len(data), bounds - base
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(0, U64), np.zeros(len(bounds), np.int64))
    inside = data != 0
    fresh = np.ones(n + 1, bool)  # a word may not continue here
    fresh[1:n] = ~inside[:-1]
    fresh[bounds[bounds <= n]] = True
    start = np.flatnonzero(inside & fresh[:n])
    stop = np.empty(n, bool)
    stop[:-1] = ~inside[1:] | fresh[1:n] & inside[1:] & inside[:-1]
    stop[-1] = True
    end = np.flatnonzero(inside & stop) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    h = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))
    return Words(data, start, end, h, np.searchsorted(start, bounds))


def batches(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first text, end, words) of the pieces of a batch."""
    data, bounds = raw_bytes(texts)
    for a, b in pieces(bounds):
        yield a, b, words_of(data, bounds[a:b + 1])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (also across texts: see ``whole``)."""
    n = max(len(h) - k + 1, 0)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * U64(0x9E3779B97F4A7C15) + h[j:j + n]
    return mix64(out + U64(k))


def whole(first: np.ndarray, n_words: int, k: int) -> np.ndarray:
    """True where k consecutive words starting here lie in one text."""
    n = max(n_words - k + 1, 0)
    ok = np.ones(n, bool)
    if n and k > 1:
        for cut in first[1:-1]:
            ok[max(cut - k + 1, 0):min(cut, n)] = False
    return ok
