"""Matching statistics of streamed regions, cut off at the window length."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def first_windows(
    index_type: Callable,
    symbols: np.ndarray,
    lengths: np.ndarray,
    counts: np.ndarray,
    order: np.ndarray,
    window: int,
) -> np.ndarray:
    """Which windows of each region occur nowhere earlier, as a bit mask per region.

    ``symbols`` (from 1) are those of all regions one after the other; region ``r`` has
    ``lengths[r]`` of them and ``counts[r]`` windows, and window ``i`` of it has the place
    ``order[r] + i``. All regions of the shard are indexed, then each is streamed from right
    to left, all in step: a match grows by one symbol to the left and, once it has the window
    length, first gives up its last symbol. The rows that match then are all places of that
    window in the shard, and the smallest place among them is its first.
    """
    n = len(lengths)
    begins = np.cumsum(lengths) - lengths + np.arange(n)
    text = np.zeros(int(lengths.sum()) + n, np.int64)
    inside = np.ones(len(text), bool)
    inside[begins + lengths] = False
    text[inside] = symbols

    place = np.full(len(text), np.iinfo(np.int64).max)
    total = int(counts.sum())
    nth = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    place[np.repeat(begins, counts) + nth] = np.repeat(order, counts) + nth
    index = index_type(text, window, place)

    by_length = np.argsort(-lengths, kind="stable")
    begin, length = begins[by_length], lengths[by_length]
    row = np.zeros(n, np.int64)
    masks = np.zeros(n, np.uint64)
    for matched in range(int(length[0]) if n else 0):
        live = int(np.searchsorted(-length, -matched, "left"))
        at = begin[:live] + length[:live] - 1 - matched
        now = row[:live]
        if matched >= window:
            now = index.shorten(now)
        row[:live] = now = index.extend(text[at], now)
        if matched >= window - 1:
            nth = length[:live] - 1 - matched
            first = index.earliest[index.group(now)] == place[at]
            masks[:live] |= first.astype(np.uint64) << nth.astype(np.uint64)
    out = np.zeros(n, np.uint64)
    out[by_length] = masks
    return out
