"""Hashes of many substrings of a text at once, with numpy.

A prefix sum of byte values times powers of an odd base (modulo 2**64) gives the hash of any
substring from two of its entries; a finalizer then mixes the bits.
"""

from __future__ import annotations

import hashlib

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = bytes(range(256)).replace(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, on unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype="uint64") * np.uint64(0xD1B54A32D192ED03))
_powers = np.ones(1, "uint64"), np.ones(1, "uint64")


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, grown as needed."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        _powers = tuple(np.concatenate([np.ones(1, "uint64"), np.cumprod(np.full(size, b))])
                        for b in (_BASE, _INVERSE))
    return _powers[0][:n], _powers[1][:n]


class Substrings:
    """Hashes of substrings of ``data``."""

    def __init__(self, data: bytes):
        up, down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, "uint64")
        np.cumsum(_VALUE[np.frombuffer(data, "uint8")] * up[:-1], out=self.sums[1:])
        self.down = down

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts]
                   + (ends - starts).astype("uint64"))

    def windows(self, width: int) -> np.ndarray:
        """Of all substrings of ``width`` bytes, by start."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n] + np.uint64(width))


class _WordHashes(dict):
    """64-bit digests of words, kept while there are not too many of them."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:                  # long words are rare and would fill the memory
            if len(self) >= 400_000:
                self.clear()
            self[word] = value
        return value


_word_hashes = _WordHashes()


def shingles(text: str, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text (A-Z lower-cased, words
    between ASCII white space); fewer than ``width`` words are one shingle.

    Words go through a cryptographic digest, so no choice of letters makes two of them meet
    (a polynomial of the bytes would let some long words do); digests are mixed in turn.
    """
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, "uint64")
    hashes = np.fromiter(map(_word_hashes.__getitem__, words), "uint64", len(words))
    many = max(1, len(words) - width + 1)
    key = np.full(many, np.uint64(min(width, len(words))))
    for k in range(min(width, len(words))):
        key = mix(key * _BASE + hashes[k:k + many])
    return np.unique(key)
