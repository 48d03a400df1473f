"""Hashes of all words of many texts at once, in numpy.

A word hash is a polynomial over its bytes modulo 2**64, taken as a difference of running sums, then mixed.
Hashes of word sequences are made of word hashes. Two different words or sequences have the same hash with
a chance of about 2**-64.
"""

from __future__ import annotations

from functools import cache

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def byte_values(seed: int = 1) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed))


_powers = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; kept for later calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, np.uint64(base), np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 23:
            _powers[base] = have
    return have[:n]


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that do not cross a text's start."""
    n = len(inside)
    starts = np.zeros(n + 1, bool)
    ends = np.zeros(n + 1, bool)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside))
    after = np.concatenate((inside, [False]))
    starts = after & (~before | edge)
    ends = before & (~after | edge)
    return np.flatnonzero(starts), np.flatnonzero(ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each span; ``table`` gives the value of a byte."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[data] * powers(n, BASE), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(n + 1, _INVERSE)[starts])


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words; run i starts at word i."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    n = len(words) - length + 1
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total = total * np.uint64(BASE) + words[k : k + n]
    return mix(total)
