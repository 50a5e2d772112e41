"""The perfect binary Golay code [23, 12, 7] as lookup tables.

Every 23-bit word lies within three bits of exactly one codeword; the top twelve bits of
that codeword are its index. Two words at most one bit apart: the index of one is always
among the nearby indices of the other (1 of them, or 6 where the nearest codeword is
three bits away).
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for k in range(22, 10, -1):
        if word >> k & 1:
            word ^= GENERATOR << (k - 11)
    return word


@lru_cache(1)
def tables():
    """(syndromes of the low 12 bits, of the high 11 bits, leader by syndrome, nearby errors by syndrome, their count)."""
    low = np.array([_remainder(x) for x in range(1 << 12)], np.int64)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], np.int64)
    leader = np.zeros(1 << 11, np.int64)
    for n in range(4):
        for bits in combinations(range(23), n):
            e = sum(1 << b for b in bits)
            leader[_remainder(e)] = e
    near = np.zeros((1 << 11, 6), np.int64)
    count = np.zeros(1 << 11, np.int64)
    single = [(1 << b, _remainder(1 << b)) for b in range(23)]
    for s in range(1 << 11):
        found = {int(leader[s])} | {e ^ int(leader[s ^ r]) for e, r in single}
        count[s] = len(found)
        near[s, : len(found)] = sorted(found)
    return low, high, leader, near, count


def _syndrome(words: np.ndarray) -> np.ndarray:
    low, high, *_ = tables()
    return low[words & 0xFFF] ^ high[words >> 12]


def home(words: np.ndarray) -> np.ndarray:
    """Index of the nearest codeword of each 23-bit word."""
    return (words ^ tables()[2][_syndrome(words)]) >> 11


def nearby(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the word, index) for the home of every word within one bit."""
    _, _, _, near, count = tables()
    s = _syndrome(words)
    n = count[s]
    at = np.repeat(np.arange(len(words)), n)
    k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    return at, (words[at] ^ near[s[at], k]) >> 11
