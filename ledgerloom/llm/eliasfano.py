"""Elias-Fano sequences: n non-decreasing numbers below u in n * (2 + log2(u / n)) bits, any of them found at once.

The low bits of each number lie packed one after another; the high parts are a bit row in which the i-th one stands
at place high + i. Select is answered from a 32-bit count of ones for each 64 bytes of that row.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 64  # bytes of the high row for each sample
_HEAD = struct.Struct("<QQBQQ")  # n, last, low bits, bytes of low and high


def pack(values: np.ndarray) -> bytes:
    """The sequence as bytes; values are non-decreasing and not negative. An empty sequence is valid."""
    values = np.asarray(values, dtype=np.uint64)
    n, last = len(values), int(values[-1]) if len(values) else 0
    low_bits = max(0, (last // n).bit_length() - 1) if n else 0
    low = values & np.uint64((1 << low_bits) - 1)
    bits = (low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1) if low_bits else np.zeros((n, 0))
    low_row = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    size = -(-(int(at[-1]) + 1 if n else 0) // (8 * BLOCK)) * BLOCK
    row = np.zeros(size * 8, dtype=np.uint8)
    row[at] = 1
    high = np.packbits(row, bitorder="little")
    before = np.concatenate([[0], np.cumsum(row.reshape(-1, 8 * BLOCK).sum(axis=1, dtype=np.int64))])[:-1] if size else np.zeros(0)
    return _HEAD.pack(n, last, low_bits, len(low_row), size) + low_row + high.tobytes() + before.astype("<u4").tobytes()


class Sequence:
    """Reads packed numbers in place: get(i) for one, all() for every one, size for the bytes taken."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.n, self.last, self.low_bits, low, high = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        self.before = np.frombuffer(data, "<u4", high // BLOCK, at + low + high)
        self.size = _HEAD.size + low + high + 4 * (high // BLOCK)

    def get(self, i: int) -> int:
        """The i-th number: one sample, one block of the high row, its low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = int(np.searchsorted(self.before, i, side="right")) - 1
        ones = np.flatnonzero(np.unpackbits(self.high[block * BLOCK : (block + 1) * BLOCK], bitorder="little"))
        high = block * BLOCK * 8 + int(ones[i - int(self.before[block])]) - i
        start = i * self.low_bits
        part = int.from_bytes(self.low[start // 8 : (start + self.low_bits + 7) // 8].tobytes(), "little") >> (start % 8)
        return high << self.low_bits | part & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        out = high.astype(np.int64) << self.low_bits
        if self.low_bits and self.n:
            bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
            out |= bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return out
