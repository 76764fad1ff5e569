"""Word shingles of whole columns at once, over the bytes of Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.Generator(np.random.PCG64(20240229))
#: A random number for each byte, A-Z as a-z.
_BYTE = _rng.integers(1, 2**64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
#: An odd number, and its inverse modulo 2**64, which takes a word's place out of its hash.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = _rng.integers(1, 2**64, 16, np.uint64) | np.uint64(1)
#: Bytes that are looked at together; one longer text makes a longer block.
BLOCK = 250_000
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """Powers of base modulo 2**64, at least n of them."""
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, BLOCK + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets between them; nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or data is None or not ends[-1]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def blocks(ends: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about size bytes."""
    i, n = 0, len(ends) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = j


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """The number of each text and its sorted distinct shingles of k words as hashes.

    A-Z are lower-cased. A text with fewer words has their whole sequence as one, and without words none.
    """
    data, ends = text_bytes(texts)
    for i, j in blocks(ends):
        part, cut = data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
        words, per = _words(part, cut)
        first = np.concatenate(([0], np.cumsum(per)))
        for t in range(j - i):
            yield i + t, np.unique(_shingles(words[first[t] : first[t + 1]], k))


def _words(part: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word and the number of words of each text."""
    n = len(part)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(cut) - 1, np.int64)
    inside = ~_BLANK[part]
    edge = np.zeros(n + 1, bool)
    edge[cut] = True
    starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])) | inside & edge[:-1])
    stops = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _power(_BASE, n)[:n], dtype=np.uint64)))
    hashes = mix((sums[stops] - sums[starts]) * _power(_INVERSE, n)[starts] + (stops - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, cut))


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words)
    if not n:
        return words
    m = min(n, k)
    total = np.full(n - m + 1, m, np.uint64)
    for i in range(m):
        total += words[i : n - m + 1 + i] * _PLACE[i]
    return mix(total)
