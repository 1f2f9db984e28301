"""A wavelet matrix over the character classes of UTF-8 text, for ranks and selects by class.

Every byte gets a class of two bits; the matrix keeps, level by level, one bit of each class,
zeros moved before ones. The rank of a class at a place is followed through the two levels, each
one look-up in a packed bit vector with running counts. Sums of ranks count the boundaries that a
unit has before any place, and bisection on that count finds the place of a unit's k-th boundary.
"""

from __future__ import annotations

import numpy as np

# Classes of bytes. A character's first byte has the character's class.
INSIDE, SPACE, WORD_BEGIN, WORD_REST = range(4)
LEVELS = 2
# A unit's boundaries are the bytes of these classes that begin one.
UNITS = {
    "char": (SPACE, WORD_BEGIN, WORD_REST),
    "word": (WORD_BEGIN,),
}


def classes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Class of every byte of consecutive UTF-8 texts that begin at ``at`` (the last is the end)."""
    lead = (data & 0xC0) != 0x80
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    out = np.where(lead, WORD_REST, INSIDE).astype(np.uint8)
    # continuation bytes never follow a blank, so the byte before tells a word's begin
    after_blank = np.zeros(len(data), bool)
    if len(data):
        after_blank[0] = True
        after_blank[1:] = blank[:-1]
        after_blank[at[:-1][at[:-1] < len(data)]] = True
    out[lead & ~blank & after_blank] = WORD_BEGIN
    out[blank] = SPACE
    return out


class WaveletMatrix:
    """Ranks of 2-bit classes over one sequence; 2 bits a symbol and a running count per 64."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.words, self.before, self.zeros = [], [], []
        for level in range(LEVELS - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.zeros(self.n // 64 + 1, np.uint64)
            packed.view(np.uint8)[: (self.n + 7) // 8] = np.packbits(bit, bitorder="little")
            ones = np.bitwise_count(packed).astype(np.int64)
            self.words.append(packed)
            self.before.append(np.cumsum(ones) - ones)
            self.zeros.append(self.n - int(ones.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[k][word] + np.bitwise_count(self.words[k][word] & low)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are ``symbol``."""
        begin, end = np.zeros_like(at), at
        for k in range(LEVELS):
            b, e = self._ones(k, begin), self._ones(k, end)
            begin, end = (self.zeros[k] + b, self.zeros[k] + e) if (symbol >> (LEVELS - 1 - k)) & 1 else (begin - b, end - e)
        return end - begin

    def boundaries(self, unit: str, at: np.ndarray) -> np.ndarray:
        """Boundaries of a unit among the first ``at`` symbols: the sum of its classes' ranks."""
        return sum((self.rank(c, at) for c in UNITS[unit]), np.zeros_like(at))

    def locate(self, unit: str, begin: np.ndarray, end: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """In each stretch [begin, end): the place where ``skip`` units end.

        That is the place of boundary number ``skip`` (from 0), or the end if the stretch has fewer.
        Bisection on the boundary count: the greatest place before which at most ``skip`` boundaries lie.
        """
        goal = self.boundaries(unit, begin) + skip
        low, high = begin.copy(), end.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            ok = self.boundaries(unit, mid) <= goal
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low
