"""A run-length index: the runs of a Burrows-Wheeler transform instead of its symbols."""

from __future__ import annotations

import numpy as np

from flatloom.llm.suffixes import suffix_order
from flatloom.llm.wavelet import BitVector

# Runs per block: symbols in a block are compared one by one.
_BLOCK_BITS = 5
_BLOCK = 1 << _BLOCK_BITS
_PLACES = np.arange(_BLOCK, dtype=np.uint8)


class RunLengthIndex:
    """Backward search on the runs of the transform of texts joined with the separator 0.

    Kept are a bit per row for the starts of runs, the symbol of each run and the total length
    of the runs of a symbol before each run. Of the suffixes' places only a sample per run is
    kept, taken where the run ends or the first ``depth`` symbols change: the smallest place
    since the sample before. ``earliest`` is the smallest sample of each group of rows with the
    same ``depth`` symbols.
    """

    def __init__(self, text: np.ndarray, depth: int, place: np.ndarray):
        order = suffix_order(text, depth)
        transform = text[order.rows - 1]
        new = np.ones(len(text), bool)
        np.not_equal(transform[1:], transform[:-1], out=new[1:])
        self._run_bits = BitVector(new)
        self._starts = np.flatnonzero(new)
        self._symbols = transform[self._starts].astype(np.int64)
        lengths = np.diff(np.append(self._starts, len(text)))
        self._n_runs = len(self._starts)
        by_symbol = np.argsort(self._symbols, kind="stable")
        # How many runs of each symbol lie before each block of runs, and the blocks themselves.
        top = int(self._symbols.max(initial=0)) + 1
        n_blocks = self._n_runs // _BLOCK + 1
        self._blocks = np.full(n_blocks * _BLOCK, top, np.uint16)
        self._blocks[: self._n_runs] = self._symbols
        of_block = np.arange(self._n_runs) // _BLOCK * top + self._symbols
        counts = np.bincount(of_block, minlength=n_blocks * top).reshape(n_blocks, top)
        first = np.cumsum(counts.sum(axis=0)) - counts.sum(axis=0)
        self._blocks = self._blocks.reshape(n_blocks, _BLOCK)
        # Together with where the runs of the symbol begin, which gives a place in the order by symbol.
        self._runs_before = np.cumsum(counts, axis=0) - counts + first
        self._before = np.concatenate([[0], np.cumsum(lengths[by_symbol])])
        sampled = np.flatnonzero(new | order.begins)
        samples = np.minimum.reduceat(place[order.rows], sampled)
        self._groups = BitVector(order.begins)
        self.earliest = np.minimum.reduceat(samples, np.searchsorted(sampled, np.flatnonzero(order.begins)))
        self._shorter = BitVector(order.begins_shorter)
        self._shorter_starts = np.flatnonzero(order.begins_shorter)

    def extend(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The first row of the matches that have ``symbol`` in front."""
        run = self._run_bits.rank(np.minimum(row + 1, self._run_bits.n)) - 1
        block, within = run >> _BLOCK_BITS, (run & (_BLOCK - 1)).astype(np.uint8)
        same = (self._blocks[block] == symbol.astype(np.uint16)[:, None]) & (_PLACES < within[:, None])
        before = self._before[self._runs_before[block, symbol] + np.count_nonzero(same, axis=1)]
        return before + np.where(self._symbols[run] == symbol, row - self._starts[run], 0)

    def shorten(self, row: np.ndarray) -> np.ndarray:
        """The first row that agrees with ``row`` in all but its last symbol."""
        return self._shorter_starts[self._shorter.rank(row + 1) - 1]

    def group(self, row: np.ndarray) -> np.ndarray:
        """The number of the group of rows with the same ``depth`` symbols."""
        return self._groups.rank(row + 1) - 1
