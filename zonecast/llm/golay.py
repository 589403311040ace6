"""Nearest-codeword keys of 64-bit fingerprints under the binary Golay code (23, 12, 7).

The code is perfect: every 23-bit word lies within 3 bits of exactly one codeword,
so decoding maps a word to one of 4096 indices.  The neighbours' indices of a word
are those of the word itself and of its one-bit changes: one index if the word is
within 2 bits of its codeword, six if it is 3 bits off.
"""

from __future__ import annotations

import itertools

import numpy as np

# Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, code length, data bits.
GENERATOR = 0b101011100011
LENGTH = 23
DATA = 12

#: low bit and width of the fingerprint's segments
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))
_CHECK = LENGTH - DATA


def _syndrome_of(word: int) -> int:
    for bit in range(LENGTH - 1, _CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - _CHECK)
    return word


_LOW = np.asarray([_syndrome_of(x) for x in range(1 << DATA)], np.uint32)
_HIGH = np.asarray([_syndrome_of(x << DATA) for x in range(1 << _CHECK)], np.uint32)


def _error_table() -> np.ndarray:
    table = np.zeros(1 << _CHECK, np.uint32)
    for weight in (1, 2, 3):
        for bits in itertools.combinations(range(LENGTH), weight):
            error = sum(1 << b for b in bits)
            table[_syndrome_of(error)] = error
    return table


_ERROR = _error_table()


def decode(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the nearest codeword of each 23-bit word."""
    w = words.astype(np.uint32)
    syndrome = _LOW[w & ((1 << DATA) - 1)] ^ _HIGH[w >> DATA]
    return ((w ^ _ERROR[syndrome]) >> _CHECK).astype(np.int64)


def neighbours(words: np.ndarray, width: int) -> np.ndarray:
    """Row per word: its own index first, then the other indices of its one-bit changes, -1 as filler."""
    own = decode(words)
    flipped = np.stack([decode(words ^ np.uint32(1 << b)) for b in range(width)], axis=1)
    flipped.sort(axis=1)
    again = np.zeros(flipped.shape, bool)
    again[:, 1:] = flipped[:, 1:] == flipped[:, :-1]
    flipped[again | (flipped == own[:, None])] = -1
    return np.concatenate([own[:, None], flipped], axis=1)


def keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``fingerprints``, key) of every key.

    Two fingerprints within 3 bits have two segments with at most one error
    each: with three errors over three segments the second-largest count is at
    most 1.  A key joins two segments' indices, one of them the word's own, the
    other a neighbour.  If x and y differ in at most one bit in either segment,
    (index of y's first, index of x's second) is a key of both: it is among x's
    neighbours of the first with x's own second, and among y's own first with
    y's neighbours of the second.
    """
    f = fingerprints.astype(np.uint64)
    near = [
        neighbours(((f >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.uint32), width)
        for low, width in SEGMENTS
    ]
    rows, out = [], []
    for n, (a, b) in enumerate(PAIRS):
        base = np.int64(n) << 24
        for left, right in ((near[a], near[b][:, :1]), (near[a][:, :1], near[b][:, 1:])):
            valid = (left >= 0) & (right >= 0)
            key = base | (np.maximum(left, 0) << 12) | np.maximum(right, 0)
            where = np.nonzero(valid)
            rows.append(where[0])
            out.append(key[where])
    return np.concatenate(rows), np.concatenate(out)
