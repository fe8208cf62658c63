"""CRC-32 of joined strings from the CRCs of their parts, with numpy.

Over GF(2), appending n bytes to a string acts on its CRC as a 32 x 32 matrix M(n), so that
crc(a + b) = M(len b) crc(a) xor crc(b). M(1) follows from the polynomial, M(n) is its n-th power. A matrix is kept as four
tables of 256 values, one for each byte of its argument: M x is the xor of four looked-up values.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np

#: Fixed value: the reversed polynomial of CRC-32, as zlib has it.
POLYNOMIAL = 0xEDB88320
#: Shifts by fewer bytes than this have a matrix of their own; longer ones are products of the powers of two.
NEAR = 64
_BYTE = np.uint32(255)


def _tables(columns: np.ndarray) -> np.ndarray:
    """Four tables of 256 values from a matrix's 32 columns."""
    out = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        out[bit // 8] ^= np.where(np.arange(256) >> (bit % 8) & 1, columns[bit], 0).astype(np.uint32)
    return out


def _times(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & _BYTE] ^ tables[1][x >> np.uint32(8) & _BYTE] ^ tables[2][x >> np.uint32(16) & _BYTE] ^ tables[3][x >> np.uint32(24)]


@functools.cache
def _one_byte() -> np.ndarray:
    """The columns of M(1): eight steps of the shift register for each unit vector."""
    x = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & np.uint32(1), x >> np.uint32(1) ^ np.uint32(POLYNOMIAL), x >> np.uint32(1))
    return x


@functools.cache
def near_shifts() -> np.ndarray:
    """The tables of M(0) to M(NEAR - 1)."""
    columns, found = np.uint32(1) << np.arange(32, dtype=np.uint32), []
    for _ in range(NEAR):
        found.append(_tables(columns))
        columns = _times(_tables(_one_byte()), columns)
    return np.stack(found)


@functools.cache
def power_shift(k: int) -> np.ndarray:
    """The tables of M(2 ** k)."""
    if k == 0:
        return _tables(_one_byte())
    half = power_shift(k - 1)
    return _tables(_times(half, _times(half, np.uint32(1) << np.arange(32, dtype=np.uint32))))


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """M(length) crc, element by element."""
    near, flat = near_shifts(), np.minimum(length, NEAR - 1)
    out = near[flat, 0, crc & _BYTE] ^ near[flat, 1, crc >> np.uint32(8) & _BYTE] ^ near[flat, 2, crc >> np.uint32(16) & _BYTE] ^ near[flat, 3, crc >> np.uint32(24)]
    far = np.flatnonzero(length >= NEAR)
    if len(far):
        x, n = crc[far], length[far]
        for k in range(int(n.max()).bit_length()):
            x = np.where(n >> k & 1, _times(power_shift(k), x), x)
        out[far] = x
    return out


def joined(left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """crc(a + b) from crc(a), crc(b) and the bytes of b."""
    return shift(left, right_length) ^ right


SPACE = np.uint32(zlib.crc32(b" "))


class WordCrcs(dict):
    """Word (bytes) to its CRC and, above 32 bits, its length; emptied when it grows past its bound."""

    BOUND = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        found = self[word] = zlib.crc32(word) | len(word) << 32
        return found
