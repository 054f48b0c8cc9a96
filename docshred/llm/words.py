"""Vectorised word view of a batch of texts (numpy over UTF-8 bytes).

A word is a maximal run of characters other than space and ``\\x09``-``\\x0D``;
those separators are single bytes in UTF-8, so the words of a whole Arrow batch
are found and hashed on the concatenated bytes without a Python loop per word.
Null texts count as empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEPARATORS = " \t\n\x0b\x0c\r"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[[ord(c) for c in SEPARATORS]] = True
_NOT_ALNUM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


@dataclass
class WordBatch:
    """Words of the texts of one batch.

    ``start``/``end``: byte range of each word in ``data``; ``first``: index of
    the first word of each text (length texts + 1); ``hash``: 64-bit hash of
    each word's bytes (lower-cased A-Z if asked)."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray | None

    def __len__(self) -> int:
        return len(self.first) - 1


def join_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array with a separator byte after each, and the
    start offset of each text (one more for the end)."""
    raw = [b"" if t is None or t != t else t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    if raw:
        np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    return np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8), offsets


def split_words(texts, hashes: bool = True, lower: bool = True, punctuation: bool = True) -> WordBatch:
    """Words of a batch; without ``punctuation`` every ASCII character that is
    no letter or digit separates words too."""
    data, offsets = join_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = ~(_IS_SEP if punctuation else _NOT_ALNUM)[data]
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    first = np.searchsorted(start, offsets)
    return WordBatch(data, offsets, start, end, first, hash_ranges(data, start, end) if hashes else None)


_BLOCK = 1 << 16


def _powers(base: int) -> np.ndarray:
    steps = np.full(2 * _BLOCK + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_POWERS = _powers(int(_MULTIPLIER))
_INVERSE = _powers(pow(int(_MULTIPLIER), -1, 1 << 64))  # the multiplier is odd


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each byte range (ranges ascend, disjoint).

    Position i of a block weighs multiplier**i; a range's prefix-sum difference
    times multiplier**-start is then its hash wherever it stands.  Ranges longer
    than a block chain the hashes of their pieces."""
    out = np.zeros(len(start), dtype=np.uint64)
    length = end - start
    lo, n = 0, len(start)
    while lo < n:
        base = int(start[lo])
        if length[lo] > _BLOCK:
            h = np.zeros(1, dtype=np.uint64)
            code = _BYTE_CODE[data[base:int(end[lo])]]
            for k in range(0, len(code), _BLOCK):
                piece = code[k:k + _BLOCK]
                h = mix(h + np.add.reduce(piece * _POWERS[:len(piece)]))
            out[lo] = h[0]
            lo += 1
            continue
        hi = int(np.searchsorted(start, base + _BLOCK))
        if length[hi - 1] > _BLOCK:
            hi -= 1
        s, e = start[lo:hi] - base, end[lo:hi] - base
        width = int(e[-1])
        sums = np.zeros(width + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[data[base:base + width]] * _POWERS[:width], out=sums[1:])
        out[lo:hi] = (sums[e] - sums[s]) * _INVERSE[s]
        lo = hi
    return mix(out ^ length.astype(np.uint64))


def windows(batch: WordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words inside a text, and the index of its
    first word."""
    n = len(batch.hash) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = batch.hash[:n].copy()
    for k in range(1, width):
        h = h * _MULTIPLIER + batch.hash[k:n + k]
    text_of = np.repeat(np.arange(len(batch)), np.diff(batch.first))
    inside = text_of[:n] == text_of[width - 1:]
    return mix(h[inside]), np.flatnonzero(inside)
