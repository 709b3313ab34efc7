"""Vantage-point trees over blocks of fingerprint bits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from flatloom.llm.text import U64


def block_masks(bits: int, blocks: int) -> list[int]:
    """Masks that cut ``bits`` bits into consecutive blocks of nearly one size."""
    edges = [bits * i // blocks for i in range(blocks + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(edges[:-1], edges[1:], strict=True)]


@dataclass
class VantageTree:
    """A complete binary tree; node ``i`` has the children ``2i + 1`` (near) and ``2i + 2`` (far).

    A fingerprint goes to the near side of a node if its masked bits differ from the vantage
    point in at most ``radii[i]`` places.
    """

    mask: int
    levels: int
    points: np.ndarray
    radii: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, mask: int, levels: int, seed: int = 7) -> VantageTree:
        """Choose vantage points from the sample, each with the median distance as its radius.

        All nodes of a level are fitted together.
        """
        rng = np.random.default_rng(seed)
        nodes = (1 << levels) - 1
        # Nodes that the sample does not reach get a random point and half of the bits as radius.
        points = rng.integers(0, 2**64, nodes, dtype=U64) & U64(mask)
        radii = np.full(nodes, int(mask).bit_count() // 2, np.int8)
        sample = rng.permutation(sample & U64(mask))
        where = np.zeros(len(sample), np.int64)
        for _ in range(levels):
            seen, first = np.unique(where, return_index=True)
            points[seen] = sample[first]
            apart = np.bitwise_count(sample ^ points[where]).astype(np.int64)
            order = np.lexsort((apart, where))
            begins = np.searchsorted(where[order], seen)
            counts = np.diff(np.append(begins, len(where)))
            median = apart[order][begins + counts // 2]
            # The median itself may hold most of the sample; take the better of two splits.
            number = np.searchsorted(seen, where)
            upto = np.bincount(number, apart <= median[number], len(seen)) / counts
            below = np.bincount(number, apart < median[number], len(seen)) / counts
            radii[seen] = np.where(abs(below - 0.5) < abs(upto - 0.5), median - 1, median)
            where = 2 * where + np.where(apart <= radii[where], 1, 2)
        return cls(mask, levels, points, radii)

    def _step(self, node: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.bitwise_count((values & U64(self.mask)) ^ self.points[node]).astype(np.int64) - self.radii[node]

    def home(self, values: np.ndarray) -> np.ndarray:
        """The leaf that holds each value."""
        node = np.zeros(len(values), np.int64)
        for _ in range(self.levels):
            node = 2 * node + np.where(self._step(node, values) <= 0, 1, 2)
        return node - ((1 << self.levels) - 1)

    def visits(self, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(value number, leaf) for all leaves that may hold a value within ``radius`` masked bits.

        By the triangle inequality such a value differs from the vantage point in at least the
        own distance less the radius and at most that much more: a side beyond is pruned.
        """
        which, node = np.arange(len(values)), np.zeros(len(values), np.int64)
        for _ in range(self.levels):
            beyond = self._step(node, values[which])
            near, far = beyond - radius <= 0, beyond + radius > 0
            which = np.concatenate([which[near], which[far]])
            node = np.concatenate([2 * node[near] + 1, 2 * node[far] + 2])
        return which, node - ((1 << self.levels) - 1)
