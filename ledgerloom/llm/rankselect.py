"""Packed bit rows with rank and select: a bit for each byte of some texts, a count of ones for each block of 64 bytes of bits.

`rank` adds the count before a block, the ones of the block's bytes before a place, and those of the last byte; `select`
finds the block by its count, the byte by the counts of the block's bytes, and the bit in a table of all bytes.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64  # bytes of the row for each count of the directory
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
POPCOUNT = _ONES.sum(axis=1, dtype=np.int64)
#: Place of the k-th one (from 0) within each byte.
_PLACE = np.argsort(1 - _ONES, axis=1, kind="stable").astype(np.int64)


class BitRow:
    """A row of bits. A call answers for many places or ranks at once."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.packed = np.concatenate([packed, np.zeros(-len(packed) % BLOCK + BLOCK, dtype=np.uint8)])
        counts = POPCOUNT[self.packed].reshape(-1, BLOCK)
        self.directory = np.concatenate([[0], np.cumsum(counts.sum(axis=1))])
        self.size, self.ones = len(bits), int(self.directory[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place, 0 to size."""
        at = np.asarray(at, dtype=np.int64)
        byte, block = at >> 3, at // (8 * BLOCK)
        within = POPCOUNT[self.packed[(block * BLOCK)[:, None] + np.arange(BLOCK)]]
        before = np.where(np.arange(BLOCK) < (byte - block * BLOCK)[:, None], within, 0).sum(axis=1)
        return self.directory[block] + before + POPCOUNT[self.packed[byte] & ((1 << (at & 7)) - 1).astype(np.uint8)]

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """Place of the one that has `rank` ones before it; the row's size for the rank after the last one."""
        ranks = np.asarray(ranks, dtype=np.int64)
        if ranks.size and not (0 <= ranks.min() and ranks.max() <= self.ones):
            raise IndexError("no such rank")
        sought = np.minimum(ranks, max(0, self.ones - 1))
        block = np.searchsorted(self.directory, sought, side="right") - 1
        block = np.minimum(block, len(self.directory) - 2)
        run = np.cumsum(POPCOUNT[self.packed[(block * BLOCK)[:, None] + np.arange(BLOCK)]], axis=1)
        left = sought - self.directory[block]
        byte = np.minimum((run <= left[:, None]).sum(axis=1), BLOCK - 1)
        left -= np.where(byte > 0, run[np.arange(len(run)), byte - 1], 0)
        place = (block * BLOCK + byte) * 8 + _PLACE[self.packed[block * BLOCK + byte], np.clip(left, 0, 7)]
        return np.where(ranks < self.ones, place, self.size)


def starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A bit for each byte of texts in UTF-8 that lie one after another: whether a unit starts there.

    A unit is a run of A-Z and a-z or one other code point. offsets: where each text begins, and where the last ends.
    """
    lower = data | 0x20
    letter = (lower >= ord("a")) & (lower <= ord("z")) & (data < 0x80)
    first = (data & 0xC0) != 0x80
    first[1:] &= ~(letter[1:] & letter[:-1])
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = True
    return first
