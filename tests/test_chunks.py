"""Runs of slices of equal size, against every way to cut."""

from itertools import combinations

import numpy as np
import pytest
from documents import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from flatloom.operators.chunks import balanced_chunks, smallest_bound


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), min_size=1, max_size=9), st.integers(1, 5))
def test_smallest_largest_chunk(sizes, chunks):
    cuts = [c for n in range(min(chunks, len(sizes))) for c in combinations(range(1, len(sizes)), n)]
    best = min(max(sum(sizes[a:b]) for a, b in zip((0, *c), (*c, len(sizes)), strict=True)) for c in cuts)
    assert smallest_bound(np.array(sizes), chunks) == best


def test_chunks(spark):
    sizes = {3: 5, 1: 9, 2: None, 10: 4, 11: 4, 20: 0}
    df = spark.createDataFrame([*sizes.items(), (10, 1)], "slice long, n int")
    assert sorted(rows(balanced_chunks(df, "slice", "n", 3))) == [(1, 9, 0), (2, 0, 0), (3, 5, 1), (10, 5, 2), (11, 4, 2), (20, 0, 2)]
    assert {r.chunk_id for r in balanced_chunks(df, "slice", "n", 1).collect()} == {0}
    # More chunks than slices: a slice is not cut.
    assert max(r.chunk_id for r in balanced_chunks(df, "slice", "n", 99).collect()) <= 5
    assert balanced_chunks(df.limit(0), "slice", "n", 3).collect() == []
    with pytest.raises(ValueError, match="chunks"):
        balanced_chunks(df, "slice", "n", 0)
    with pytest.raises(ValueError, match="below zero"):
        balanced_chunks(spark.createDataFrame([(1, -1)], "slice long, n int"), "slice", "n", 1)
