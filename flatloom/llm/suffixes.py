"""Sorting suffixes by a bounded number of symbols, by prefix doubling."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def dense_ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, rank of each item from 0, where a new rank begins in the order)."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(new) - 1
    return order, ranks, new


def pair_ranks(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for pairs of numbers up to ``n``.

    Pair and index share one integer if they fit, as plain sorting is faster than finding an order.
    """
    n = len(high)
    bits = int(n + 1).bit_length()
    if 3 * bits > 63:
        return dense_ranks(high * (n + 1) + low)
    packed = (high << 2 * bits) | (low << bits) | np.arange(n)
    packed.sort()
    order = packed & ((1 << bits) - 1)
    packed >>= bits
    new = np.ones(n, bool)
    np.not_equal(packed[1:], packed[:-1], out=new[1:])
    ranks = np.empty(n, np.int64)
    ranks[order] = np.cumsum(new) - 1
    return order, ranks, new


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` places further on, plus one; 0 beyond the end."""
    out = np.zeros(len(values), np.int64)
    if by < len(values):
        out[: len(values) - by] = values[by:] + 1
    return out


@dataclass
class SuffixOrder:
    """Suffixes sorted by their first ``depth`` symbols.

    ``begins`` marks the rows at which these symbols change, ``begins_shorter`` those at
    which the first ``depth - 1`` symbols change.
    """

    rows: np.ndarray
    begins: np.ndarray
    begins_shorter: np.ndarray


def suffix_order(text: np.ndarray, depth: int) -> SuffixOrder:
    """Sort the suffixes of ``text`` (integers from 0) by their first ``depth`` symbols.

    As many symbols as fit go into the first key; each further round sorts by the ranks of
    two overlapping or adjoining prefixes.
    """
    n = len(text)
    bits = max(1, int(text.max(initial=0) + 1).bit_length())
    span = max(1, min(depth, 62 // bits))
    if span == depth and depth > 1:
        span = depth - 1
    key = np.zeros(n, np.int64)
    for j in range(span):
        key = (key << bits) | _shifted(text.astype(np.int64), j)
    rows, ranks, begins = dense_ranks(key)
    if depth == 1:
        return SuffixOrder(rows, begins, np.arange(n) == 0)
    while True:
        step = min(span, depth - span)
        rows, new_ranks, begins = pair_ranks(ranks, _shifted(ranks, step))
        if span + step == depth:
            break
        ranks, span = new_ranks, span + step
    shorter = begins.copy()
    if step > 1:
        other = _shifted(ranks, step - 1)[rows]
        same = ranks[rows]
        shorter[1:] = (same[1:] != same[:-1]) | (other[1:] != other[:-1])
    else:
        same = ranks[rows]
        shorter[1:] = same[1:] != same[:-1]
    return SuffixOrder(rows, begins, shorter)
