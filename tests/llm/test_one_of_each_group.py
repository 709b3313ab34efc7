"""Null and repeated ids among near copies."""

import pytest

from flatloom.llm import simhash


@pytest.mark.parametrize("i", [None, 3])
def test_one_row_of_each_component(frame, i):
    one = " ".join(f"word{k}" for k in range(60))
    two = " ".join(f"other{k * k}" for k in range(60))
    docs = [(i, one), (i, one.upper()), (i, one), (i, two), (8, two), (9, two.title()), (9, "single")]
    left = simhash.one_of_each_group(frame(docs)).collect()
    found = sorted(r.text.lower() for r in left)
    assert found == sorted([one, two, "single"])
    assert all(r.doc_id == (9 if r.text == "single" else i) for r in left)
