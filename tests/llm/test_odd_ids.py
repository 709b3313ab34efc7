"""Null and repeated ids in the stages that drop documents."""

import pytest

from flatloom.llm import exact_dedup, repeats, substring_dedup, suffix_dedup


@pytest.mark.parametrize("i", [None, 5])
def test_copies_of_one_id_in_other_white_space(frame, i):
    """The longest stays; it is not dropped with the shorter copy of the same id."""
    docs = [(i, "a b c"), (i, "a  b \n c"), (9, "a b c"), (10, "other")]
    left = exact_dedup.without_copies(frame(docs)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(i or 0, "a  b \n c"), (10, "other")])


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeats_of_rows_without_id(frame, monkeypatch, hot):
    """Each is a document of its own before all ids: one keeps a passage that many of them have."""
    monkeypatch.setattr(repeats, "HOT", hot)
    passage = " ".join(f"shared{n}" for n in range(30))
    docs = [(None, f"{passage} own{i}") for i in range(40)] + [(1, passage), (2, "alone")]
    found = substring_dedup.repeated_words(frame(docs)).select("row.doc_id", "n_units", "n_removed").collect()
    assert sorted((r.doc_id or 0, r.n_units, r.n_removed) for r in found) == sorted(
        [(0, 31, 0), *[(0, 31, 30)] * 39, (1, 30, 30), (2, 1, 0)]
    )
    found = suffix_dedup.repeated_bytes(frame(docs)).select("row.doc_id", "n_removed").collect()
    whole = len(passage) + 1
    assert sorted(r.n_removed for r in found if r.doc_id is None)[0] == 0
    # Texts that begin their last word alike share a few bytes more.
    assert all(whole + 3 <= n <= whole + 4 for n in sorted(r.n_removed for r in found if r.doc_id is None)[1:])
    assert {r.doc_id: r.n_removed for r in found if r.doc_id} == {1: len(passage), 2: 0}


def test_lists_of_rows_without_id_stay_small(frame):
    """No row lists the anchors of others that have no id either."""
    docs = frame([(None, " ".join(f"w{i}x{n}" for n in range(60))) for i in range(20) for _ in range(3)])
    keyed = docs.select(repeats._document_key("doc_id", "text").alias("id"), "text")
    what = repeats.Repeats("words", 20, 8, None)
    lists = repeats.candidates(keyed, what).collect()
    assert len(lists) == 20 and max(len(r.cold) + len(r.hot) for r in lists) <= 60


def test_only_open_groups_are_read_in_full(frame):
    """Rows without an id, one of which has a copy: the digests of the others are never taken."""
    docs = frame([(None, f"text {i} of its own length {'x' * i}") for i in range(30)] + [(None, "a copy"), (3, "a  copy")])
    found = exact_dedup.decisions(docs).collect()
    assert len(found) == 32
    assert sorted((r.doc_id or 0, r.group_size, r.kept) for r in found if r.text_sha256) == [(0, 2, False), (3, 2, True)]
