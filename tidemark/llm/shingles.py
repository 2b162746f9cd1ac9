"""Shingle sets and their fast similarity sketches, one text at a time.

Helpers that run inside Spark tasks. A shingle is five words in a row, hashed to
64 bits; a text of fewer words is one shingle.

The sketch has T coordinates, and two sets agree in a coordinate with the
probability of their Jaccard similarity. In round ``i`` every element is thrown
into a hashed bin, with a value of ``i`` plus a hashed fraction; a bin keeps its
least value. After T rounds the bins go in turn: in round ``T + j`` all elements
go to bin ``j``, so that every bin is filled for sure. Rounds end once all bins
are filled, which for large sets is after one or two: the whole sketch costs
about O(n + T log T) instead of O(n T), and the even filling gives the estimate
the concentration of T independent samples.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

SHINGLE = 5
ROWS = 4
BANDS = 48
COORDINATES = ROWS * BANDS
_ROUND_SHIFT = 54  # a value is its round above a fraction of 54 bits; rounds go up to 2 T < 1024
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.array([int.from_bytes(hashlib.blake2b(b"%d" % i, digest_size=8).digest()) for i in range(2 * COORDINATES)], np.uint64)
_CACHE_ENTRIES = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= _CACHE_ENTRIES:
                self.clear()
            self[word] = value
        return value


_words = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the input (a bijection on 64 bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted; empty without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: ASCII rules only
    if not words:
        return np.empty(0, np.uint64)
    hashes = hashed_words(words)
    width = min(SHINGLE, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total = (total + hashes[k : k + len(total)]) * _MULTIPLIER
    return np.unique(mixed(total + np.uint64(width)))


def sketch(elements: np.ndarray) -> np.ndarray:
    """T coordinates of a set that is not empty."""
    n, t = len(elements), COORDINATES
    filled = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    empty, first = np.iinfo(np.uint64).max, 0
    while first < t and (first == 0 or (filled == empty).any()):
        # Later rounds have larger values, so rounds more than needed change nothing.
        rounds = min(t - first, max(1, 2 * t // n))
        h = mixed(elements[None, :] ^ _SEEDS[first : first + rounds, None])
        number = np.arange(first, first + rounds, dtype=np.uint64)[:, None] << np.uint64(_ROUND_SHIFT)
        value = number | (h >> np.uint64(64 - _ROUND_SHIFT))
        bins = (mixed(h) >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)
        np.minimum.at(filled, bins.ravel().astype(np.intp), value.ravel())
        first += rounds
    for j in np.flatnonzero(filled == empty):
        h = mixed(elements ^ _SEEDS[t + j]).min()
        filled[j] = (np.uint64(t + j) << np.uint64(_ROUND_SHIFT)) | (h >> np.uint64(64 - _ROUND_SHIFT))
    return filled


def band_hashes(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band of coordinates; equal bands of different places differ."""
    rows = coordinates.reshape(BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        total = mixed(total * _MULTIPLIER + rows[:, k])
    return total


def set_digest(elements: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sets."""
    both = np.sort(np.concatenate([a, b]))
    return int((both[1:] == both[:-1]).sum())
