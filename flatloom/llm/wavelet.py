"""A compressed full-text index: bit-packed wavelet levels over a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

from flatloom.llm.suffixes import suffix_order
from flatloom.llm.text import U64


class BitVector:
    """Packed bits with a running count per 64 of them."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
        raw = np.packbits(bits, bitorder="little")
        packed[: len(raw)] = raw
        self._words = packed.view(U64)
        self._before = np.zeros(len(self._words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self._words), out=self._before[1:])
        self.ones = int(self._before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many ones lie before each position."""
        word = at >> 6
        below = (U64(1) << (at & 63).astype(U64)) - U64(1)
        return self._before[word] + np.bitwise_count(self._words[word] & below)


class WaveletMatrix:
    """Counts of a symbol before a position, through one bit level per symbol bit."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self._levels: list[tuple[BitVector, int]] = []
        for shift in range(self.bits - 1, -1, -1):
            bit = (symbols >> shift) & 1 == 1
            self._levels.append((BitVector(bit), int(len(symbols) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` ends up below all levels on the path of ``symbol``."""
        for level, (vector, zeros) in enumerate(self._levels):
            ones = vector.rank(at)
            taken = (symbol >> (self.bits - 1 - level)) & 1 == 1
            at = np.where(taken, zeros + ones, at - ones)
        return at


class FmIndex:
    """Backward search over texts that are joined with the separator 0.

    Rows are ordered by ``depth`` symbols, so a search may match up to ``depth`` symbols.
    ``earliest`` is the smallest ``place`` in each group of rows with the same ``depth`` symbols;
    no other places of suffixes are kept.
    """

    def __init__(self, text: np.ndarray, depth: int, place: np.ndarray):
        order = suffix_order(text, depth)
        top = int(text.max(initial=0))
        counts = np.bincount(text, minlength=top + 1)
        self._wavelet = WaveletMatrix(text[order.rows - 1], top)
        symbols = np.arange(top + 1)
        first = np.cumsum(counts) - counts
        self._shift = first - self._wavelet.descend(symbols, np.zeros(top + 1, np.int64))
        self.earliest = np.minimum.reduceat(place[order.rows], np.flatnonzero(order.begins))
        self._shorter = BitVector(order.begins_shorter)
        self._shorter_starts = np.flatnonzero(order.begins_shorter)
        self._groups = BitVector(order.begins)

    def extend(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The first row of the matches that have ``symbol`` in front."""
        return self._shift[symbol] + self._wavelet.descend(symbol, row)

    def shorten(self, row: np.ndarray) -> np.ndarray:
        """The first row that agrees with ``row`` in all but its last symbol."""
        return self._shorter_starts[self._shorter.rank(row + 1) - 1]

    def group(self, row: np.ndarray) -> np.ndarray:
        """The number of the group of rows with the same ``depth`` symbols."""
        return self._groups.rank(row + 1) - 1
