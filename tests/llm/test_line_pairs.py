"""Line dedup against the alignment of every pair of documents, without a limit on partners."""

from collections import Counter

import brute
import numpy as np
import pytest
import xxhash

from flatloom.llm import line_dedup


def own_lines(text):
    seen, own = Counter(), []
    for x in (text or "").split("\n"):
        if brute.words(x):
            own.append((x, seen[x]))
            seen[x] += 1
    return own


def every_pair(docs, min_words=8):
    lines = {i: own_lines(t) for i, t in sorted(docs)}
    out = {}
    for b, later in lines.items():
        gone = set()
        for a in (a for a in lines if a < b):
            place = {key: n for n, key in enumerate(lines[a])}
            common = [(place[key], n, len(brute.words(key[0]))) for n, key in enumerate(later) if key in place]
            if common:
                gone |= set(line_dedup.aligned_blocks(*map(list, zip(*common, strict=True)), min_words))
        out[b] = (len(later), len(gone))
    return out


def removed(frame, docs, **options):
    found = line_dedup.without_aligned_lines(frame(docs), **options)
    return {r[0]: tuple(r[1:]) for r in found.select("row.doc_id", "n_lines", "n_removed").collect()}


L1, L2 = "one two three four five", "six seven eight nine ten"


def test_a_frequent_block_whose_lines_have_other_first_holders(frame):
    docs = [(1, L1), (2, L2), *((i, f"own {i}\n{L1}\n{L2}") for i in range(3, 13))]
    found = removed(frame, docs)
    assert found == every_pair(docs)
    assert [found[i][1] for i in range(1, 13)] == [0, 0, 0] + [2] * 9


def test_frequent_lines_between_rare_ones_do_not_break_a_copy(frame):
    labels = [f"label {k}" for k in range(4)]
    others = [(i, "\n".join([*labels[i % 4 :], f"other {i}"])) for i in range(1, 10)]
    copied = "\n".join(x for k in range(4) for x in (f"rare line number {k} here", labels[k]))
    docs = [*others, (100, copied), (101, copied)]
    found = removed(frame, docs)
    assert found == every_pair(docs)
    assert found[101] == (8, 8)


@pytest.mark.parametrize("rare", [line_dedup.RARE_DOCUMENTS, 1])
def test_blocks_that_only_a_later_holder_has_in_order(frame, rare):
    """The first holder has two frequent blocks the other way round."""
    up, down = f"{L1}\n{L2}", "a b c d e f g h i"
    docs = [(i, f"{up}\nown {i}\n{down}" if i % 3 else f"{down}\nown {i}\n{up}") for i in range(30)]
    found = removed(frame, docs, rare=rare)
    assert found == every_pair(docs)
    assert found[29][1] == 3


@pytest.mark.parametrize("rare", [line_dedup.RARE_DOCUMENTS, 1])
def test_random_lines(frame, rare):
    rng = np.random.default_rng(11)
    pool = [" ".join(f"w{n}" for _ in range(int(rng.integers(1, 7)))) for n in range(14)]
    docs = [(int(i), "\n".join(pool[n] for n in rng.integers(0, 14, rng.integers(0, 12)))) for i in rng.permutation(60)]
    assert removed(frame, docs, rare=rare) == every_pair(docs)


def kept_texts(docs, min_words=8):
    """What stays of every row, aligned by comparing all increasing sequences' lengths; rows in any order."""
    def order(row):
        return (-(2**63) if row[0] is None else row[0], xxhash.xxh64_intdigest((row[1] or "").encode(), seed=42))

    rows = sorted(set(docs), key=order)
    out = {}
    for n, (i, text) in enumerate(rows):
        lines, gone = own_lines(text), set()
        for _, other in rows[:n]:
            place = {key: at for at, key in enumerate(own_lines(other))}
            common = [(place[k], at, len(brute.words(k[0]))) for at, k in enumerate(lines) if k in place]
            if common:
                best = [1] * len(common)
                for y in range(len(common)):
                    best[y] += max((best[x] for x in range(y) if common[x][0] < common[y][0]), default=0)
                gone_here = line_dedup.aligned_blocks(*map(list, zip(*common, strict=True)), min_words)
                assert len(line_dedup.longest_increasing([c[0] for c in common])) == max(best)
                gone |= set(gone_here)
        kept, at = [], 0
        for x in (text or "").split("\n"):
            if brute.words(x):
                if at not in gone:
                    kept.append(x + "\n")
                at += 1
            else:
                kept.append(x + "\n")
        joined = "".join(kept)
        # The line feed after the last line exists only if that line is there and had one.
        whole = (text or "") + "\n"
        out[i, text] = joined[:-1] if joined and whole.endswith(kept[-1]) and (at == 0 or at - 1 not in gone or not brute.words((text or "").split("\n")[-1])) else joined
    return Counter((i, out[i, t]) for i, t in docs)


def kept_rows(frame, docs):
    found = line_dedup.without_aligned_lines(frame(docs), output="text").select("row.doc_id", "kept").collect()
    return Counter((r.doc_id, bytes(r.kept).decode()) for r in found)


OWN = [f"a line of its own number {i}" for i in range(12)]
BLOCK = f"{L1}\n{L2}"
REPEATED = [
    # A row that shares the id of one that loses a block, and rows after it.
    [(1, BLOCK), (5, "\n".join([*OWN[:6], BLOCK])), (5, "just this line"), (6, "\n".join(OWN))],
    [(1, BLOCK), (6, "\n".join(OWN)), (5, "\n".join([*OWN[:6], BLOCK])), (5, "just this line")],
    [(1, BLOCK), (5, "\n".join([*OWN[:6], BLOCK])), (5, "\n".join(f"another line number {i}" for i in range(12)))],
    # Rows of one id share a block; rows repeated as a whole; ids that are null.
    [(5, f"x\n{BLOCK}\ny"), (5, f"{BLOCK}\nz"), (5, f"{BLOCK}\nz"), (None, "p\nq"), (None, BLOCK), (None, f"r\n{BLOCK}"), (0, f"{BLOCK}\nend")],
]


@pytest.mark.parametrize("docs", REPEATED)
def test_repeated_and_null_ids_by_value(frame, docs):
    # In one partition, so that rows stand behind each other in one batch.
    assert kept_rows(lambda rows: frame(rows).coalesce(1), docs) == kept_texts(docs)


def test_unique_lines_stay_with_repeated_ids(frame):
    for docs in REPEATED[:3]:
        left = kept_rows(frame, docs)
        lines = Counter(x for (_, text), n in left.items() for x in text.split("\n") * n)
        assert all(lines[x] >= 1 for _, text in docs for x in text.split("\n"))


def test_many_null_ids(frame):
    docs = [(None, f"{BLOCK}\nown {i}" if i % 2 else f"own {i}") for i in range(200)]
    left = kept_rows(frame, docs)
    assert left == kept_texts(docs)
    assert sum(BLOCK in text for _, text in left.elements()) == 1
