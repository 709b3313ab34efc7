"""Texts that polynomials modulo 2**64 cannot tell apart."""

import brute
import numpy as np

from flatloom.llm import line_dedup, quality
from flatloom.llm.text import Rolling, byte_values, item_hashes


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


A, B = thue_morse(2048, "ab"), thue_morse(2048, "ba")


def test_long_items_are_told_apart():
    data = np.frombuffer((A + B + A).encode(), np.uint8)
    starts, ends = np.array([0, 2048, 4096]), np.array([2048, 4096, 6144])
    plain = Rolling(byte_values(data)).ranges(starts, ends)
    assert plain[0] == plain[1]
    found = item_hashes(data, starts, ends)
    assert found[0] == found[2] != found[1]


def test_lines_and_words_of_quality_rules(frame):
    text = f"{A}\n{B}\n" + " ".join(f"word{i}" for i in range(60)) + f"\nx {A} y x {B} y\n{A}"
    found = quality.judged(frame([(1, text)]), measures=("n_dup_lines", "n_repeat_words")).first()
    expected = brute.quality(text)
    assert (found.n_dup_lines, found.n_repeat_words) == (expected[3], expected[4]) == (1, 0)


def test_lines_of_pairs(frame):
    eight = " ".join("abcdefgh")
    docs = [(1, f"{A} {eight}"), (2, f"{B} {eight}"), (3, f"{A} {eight}")]
    found = line_dedup.without_aligned_lines(frame(docs)).select("row.doc_id", "n_removed").collect()
    assert {r.doc_id: r.n_removed for r in found} == {1: 0, 2: 0, 3: 1}
