"""CRC-32C of many byte strings at once with numpy, and the record-file mask.

A CRC register is linear over XOR, so the checksum of a message is the XOR of the
registers of its 64-byte blocks, each advanced past the bytes that follow it.
All blocks of a batch are reduced together, then neighbours are merged level by
level; every step is a table lookup over a whole array.
"""

from __future__ import annotations

import numpy as np

# Reflected Castagnoli polynomial, register start and end, mask constant.
POLYNOMIAL = 0x82F63B78
ALL_ONES = 0xFFFFFFFF
MASK_DELTA = 0xA282EAD8

BLOCK = 64


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1).astype(np.uint32)
    return t


_BYTE = _byte_table()


def _position_tables() -> np.ndarray:
    """Row i: register after byte value v at block position i and zeros up to the block's end."""
    rows = [_BYTE]
    for _ in range(BLOCK - 1):
        last = rows[-1]
        rows.append((last >> 8) ^ _BYTE[last & 0xFF])
    return np.stack(rows[::-1])


_POSITION = _position_tables()


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (tables[0][crc & 0xFF] ^ tables[1][(crc >> 8) & 0xFF]
            ^ tables[2][(crc >> 16) & 0xFF] ^ tables[3][crc >> 24])


def _advance_tables(levels: int) -> list[np.ndarray]:
    """Level k: four byte tables that advance a register past BLOCK * 2**k zero bytes."""
    one = np.zeros((4, 256), np.uint32)
    for j in range(4):
        # a register byte behaves like a message byte that is followed by the rest of the block
        one[j] = _POSITION[j]
    out = [one]
    for _ in range(levels - 1):
        t = out[-1]
        out.append(np.stack([_apply(t, t[j]) for j in range(4)]))
    return out


_ADVANCE = _advance_tables(26)


def crc32c(messages: list[bytes]) -> np.ndarray:
    """CRC-32C of each message, as uint32."""
    n = np.fromiter((len(m) for m in messages), np.int64, len(messages))
    if not len(n):
        return np.zeros(0, np.uint32)
    # Zero bytes in front leave a zero register alone.  The register's start value is the
    # same as inverting the first four bytes; shorter messages go the plain way.
    blocks = np.maximum(1, -(-n // BLOCK))
    ends = np.cumsum(blocks) * BLOCK
    flat = np.zeros(int(ends[-1]), np.uint8)
    for m, size, end in zip(messages, n.tolist(), ends.tolist()):
        if size >= 4:
            flat[end - size:end] = np.frombuffer(m, np.uint8)
            flat[end - size:end - size + 4] ^= 0xFF
    grid = flat.reshape(-1, BLOCK)
    crc = np.zeros(len(grid), np.uint32)
    for i in range(BLOCK):
        crc ^= _POSITION[i][grid[:, i]]
    count = blocks
    for tables in _ADVANCE:
        if (count == 1).all():
            break
        even = count + (count & 1)
        starts = np.cumsum(even) - even
        room = np.zeros(int(even.sum()), np.uint32)
        place = np.repeat(starts + (count & 1), count) + (
            np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
        room[place] = crc
        # a record of one block grows a zero block in front, which changes nothing
        crc = _apply(tables, room[0::2]) ^ room[1::2]
        count = even // 2
    crc = crc ^ np.uint32(ALL_ONES)
    for i in np.flatnonzero(n < 4):
        r = ALL_ONES
        for byte in messages[i]:
            r = (r >> 8) ^ int(_BYTE[(r ^ byte) & 0xFF])
        crc[i] = r ^ ALL_ONES
    return crc


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and offset, so that a checksum stored among data does not look like data."""
    c = crc.astype(np.uint64)
    return (((c >> 15) | (c << 17)) + MASK_DELTA & ALL_ONES).astype("<u4")
