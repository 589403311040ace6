"""Hashed n-gram features of UTF-8 text, computed with numpy over whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: longer texts are read in windows of this many bytes that overlap by ``OVERLAP``
WINDOW = 4 << 20
OVERLAP = 64

#: odd multipliers that spread a gram's symbols over 32 bits; a gram's order picks the row start
_MULTIPLIERS = np.asarray([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


def windows(text: bytes) -> Iterator[bytes]:
    if len(text) <= WINDOW:
        yield text
        return
    for start in range(0, len(text) - OVERLAP, WINDOW - OVERLAP):
        yield text[start:start + WINDOW]


def grams(symbols: np.ndarray, orders: tuple[int, ...], bits: int, salt: int = 0) -> list[np.ndarray]:
    """Bucket (0 to 2**bits - 1) of every run of n symbols, for every n of ``orders``."""
    wide = symbols.astype(np.uint32) + np.uint32(1 + salt)
    out = []
    for n in orders:
        size = len(wide) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n * 0x3C6EF372 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h ^= wide[k:k + size]
            h *= _MULTIPLIERS[k]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out.append((h >> np.uint32(32 - bits)).astype(np.int32))
    return out


# --- word shapes ---------------------------------------------------------------

#: symbol classes of bytes: 0 blank, 1 lower-case or beyond ASCII, 2 upper-case, 3 digit, others themselves
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[128:] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_AGAIN = 4  # stands before a word that equals the word before it


def shapes(text: bytes) -> np.ndarray:
    """Class symbols of the text with equal neighbours run together; repeats of a word are marked."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint8)
    kind = _CLASS[raw]
    inside = kind != 0
    edge = np.empty(len(kind), bool)
    edge[0], edge[1:] = True, kind[1:] != kind[:-1]
    symbols = kind[edge]
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    if len(starts) < 2:
        return symbols
    # a word's hash: its bytes weighted by their place in the word, and its length
    place = np.arange(len(raw), dtype=np.int32)
    word = np.cumsum(np.bincount(starts, minlength=len(raw)), dtype=np.int32) - 1
    place -= starts[np.maximum(word, 0)].astype(np.int32)
    weight = (place.astype(np.uint32) * np.uint32(2) + np.uint32(1)) * np.uint32(0x9E3779B1)
    weight ^= weight >> np.uint32(13)
    value = np.where(inside, (raw.astype(np.uint32) + np.uint32(7)) * weight, np.uint32(0))
    hashes = np.add.reduceat(value, starts)
    again = starts[1:][hashes[1:] == hashes[:-1]]
    if not len(again):
        return symbols
    at = np.cumsum(edge)[again] - 1  # the symbol that starts the repeated word
    return np.insert(symbols, at, _AGAIN)


def indicators(text: bytes, bits: int) -> np.ndarray:
    """Sorted distinct buckets of byte 3- and 4-grams and of shape 1- to 4-grams."""
    seen = np.zeros(1 << bits, bool)
    for part in windows(text):
        for g in grams(np.frombuffer(part.lower(), np.uint8), (3, 4), bits):
            seen[g] = True
        for g in grams(shapes(part), (1, 2, 3, 4), bits, salt=1000):
            seen[g] = True
    return np.flatnonzero(seen).astype(np.int32)


# --- letters -------------------------------------------------------------------

_LETTERS = bytes(
    c if c >= 128 or chr(c).isalpha() else 32 for c in (ord(chr(b).lower()) if b < 128 else b for b in range(256))
)


def letter_counts(text: bytes, bits: int) -> np.ndarray:
    """Counts by bucket of 2- to 4-grams over letters (ASCII lower-cased, all else blank)."""
    counts = np.zeros(1 << bits, np.float32)
    for part in windows(text):
        symbols = np.frombuffer(b" ".join(part.translate(_LETTERS).split()), np.uint8)
        for g in grams(symbols, (2, 3, 4), bits):
            counts += np.bincount(g, minlength=1 << bits)
    return counts
