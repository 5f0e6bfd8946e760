"""Fuzzy keys from the perfect binary Golay code of length 23.

Every 23-bit word lies within three bits of exactly one codeword. A word's *key* is the number of that
codeword; its *near keys* are the keys of all words one bit away and its own, one to six of them. Two
words that differ in at most two bits share a near key, since a word between them is one bit from both.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# Fixed value: a generator polynomial of the code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
BITS, CHECK_BITS = 23, 11


def _remainder(word: int) -> int:
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 bits, of the high 11 bits, and the error of every remainder."""
    low = np.array([_remainder(w) for w in range(1 << 12)], dtype=np.int64)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], dtype=np.int64)
    errors = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(BITS), weight):
            word = sum(1 << b for b in bits)
            errors[_remainder(word)] = word
    return low, high, errors


LOW, HIGH, ERRORS = _tables()


def keys(words: np.ndarray) -> np.ndarray:
    """The number, 0 to 4095, of the codeword nearest to each word."""
    words = words.astype(np.int64)
    return (words ^ ERRORS[LOW[words & 0xFFF] ^ HIGH[words >> 12]]) >> CHECK_BITS


def near_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all words at most one of the low `bits` away: positions in `words`, and keys."""
    words = words.astype(np.int64)
    around = np.concatenate([words[:, None], words[:, None] ^ (1 << np.arange(bits, dtype=np.int64))[None, :]], axis=1)
    found = np.sort(keys(around), axis=1)
    first = np.ones(found.shape, dtype=bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(first)[0], found[first]
