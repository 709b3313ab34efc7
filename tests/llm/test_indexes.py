"""The full-text indexes and suffix sorting on random texts, against plain Python."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flatloom.llm.matching import first_windows
from flatloom.llm.runindex import RunLengthIndex
from flatloom.llm.suffixes import suffix_order
from flatloom.llm.vptree import VantageTree, block_masks
from flatloom.llm.wavelet import BitVector, FmIndex, WaveletMatrix

SYMBOLS = st.lists(st.integers(0, 5), min_size=1, max_size=120)


@settings(max_examples=40, deadline=None)
@given(SYMBOLS, st.integers(1, 12))
def test_suffix_order(symbols, depth):
    found = suffix_order(np.array(symbols), depth)
    cut = [tuple(symbols[i : i + depth]) for i in range(len(symbols))]
    ordered = [cut[i] for i in found.rows]
    assert ordered == sorted(cut)
    assert sorted(found.rows.tolist()) == list(range(len(symbols)))
    changes = [i == 0 or ordered[i] != ordered[i - 1] for i in range(len(cut))]
    assert found.begins.tolist() == changes
    if depth > 1:
        shorter = [i == 0 or ordered[i][: depth - 1] != ordered[i - 1][: depth - 1] for i in range(len(cut))]
        assert found.begins_shorter.tolist() == shorter


@settings(max_examples=40, deadline=None)
@given(SYMBOLS)
def test_ranks(symbols):
    symbols = np.array(symbols)
    at = np.arange(len(symbols) + 1)
    bits = symbols % 2 == 1
    assert BitVector(bits).rank(at).tolist() == [int(bits[:i].sum()) for i in at]
    matrix = WaveletMatrix(symbols, 5)
    for s in range(6):
        of = np.full(len(at), s)
        counts = matrix.descend(of, at) - matrix.descend(of, np.zeros_like(at))
        assert counts.tolist() == [int((symbols[:i] == s).sum()) for i in at]


@pytest.mark.parametrize("index_type", [FmIndex, RunLengthIndex])
@settings(max_examples=40, deadline=None)
@given(st.integers(1, 7), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=5), min_size=1, max_size=8), st.randoms())
def test_first_windows(index_type, window, tails, random):
    """Regions of up to five windows: a window is first where its symbols stand at the smallest place."""
    regions = [[random.randint(1, 3) for _ in range(window - 1)] + tail for tail in tails]
    order = random.sample(range(0, 1000, 10), len(regions))
    counts = np.array([len(tail) for tail in tails])
    first: dict = {}
    for region, place, n in zip(regions, order, counts, strict=True):
        for i in range(n):
            key = tuple(region[i : i + window])
            first[key] = min(first.get(key, place + i), place + i)
    expected = [
        sum((first[tuple(region[i : i + window])] == place + i) << i for i in range(n))
        for region, place, n in zip(regions, order, counts, strict=True)
    ]
    symbols, lengths = np.array([s for r in regions for s in r]), np.array([len(r) for r in regions])
    found = first_windows(index_type, symbols, lengths, counts, np.array(order), window)
    assert found.tolist() == expected


@pytest.mark.parametrize("levels", [0, 3, 6])
def test_a_leaf_within_reach_is_visited(levels):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**64, 500, dtype=np.uint64)
    near = values ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))
    for mask in block_masks(64, 3):
        tree = VantageTree.fit(values[:100], mask, levels)
        which, leaf = tree.visits(values, 1)
        visited = set(zip(which.tolist(), leaf.tolist(), strict=True))
        assert all((i, leaf) in visited for i, leaf in enumerate(tree.home(near).tolist()))
    assert sum(m.bit_count() for m in block_masks(64, 3)) == 64
