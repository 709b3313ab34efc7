"""The prefix trie against a plain version over whole conversations."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from flatloom.llm import prefix_trie
from flatloom.llm.prefix_trie import prefix_nodes
from flatloom.llm.queries import QUERIES

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
LOW = -(2**63)


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).digest()
        tie = [int.from_bytes(digest[i : i + 8], "big", signed=True) for i in (0, 8)]
        turns[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    paths = {}
    for c, t in own.items():
        h = zlib.crc32(b"" if c is None else str(c).encode()) % 4
        base = c if c is None else c - int(c - 20 * int(c / 20))
        paths[c] = tuple(own.get(base, [])[:h] + t[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    low = lambda cs: min(cs, key=lambda c: LOW if c is None else c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * n_words + sum(saved[x] for x in children[node])
    out = []
    for node, cs in members.items():
        ends = sorted((c for c in cs if paths[c] == node), key=lambda c: LOW if c is None else c)
        joined = ",".join("" if c is None else str(c) for c in ends)
        out.append((
            low(cs), len(node), low(members[node[:-1]]) if node else None, len(cs), len(children[node]), leaves[node],
            saved[node], hashlib.sha256(joined.encode()).hexdigest(),
        ))
    return Counter(out)


def nodes_of(spark, rows, **options):
    # Another column has a name that the operator uses inside.
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    return Counter(tuple(r) for r in prefix_nodes(table, **options).select(*COLUMNS).collect())


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_prefix_trie"](spark, sf_dir)
    assert Counter(tuple(r) for r in found.select(*COLUMNS).collect()) == brute(rows)


def talk(c, *texts):
    return [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


FORKS = [
    # Copies, forks at several depths, a conversation that ends where others go on, and long shared stretches.
    *talk(1, "a b", "c", "d e f", "g"), *talk(2, "a b", "c", "d e f", "g"), *talk(3, "a b", "c", "x"), *talk(5, "a b", "c"),
    *talk(6, *"abcdefghijklmnop"), *talk(7, *"abcdefghijklmnoq"), *talk(8, *"abcdefgh"), *talk(20, *"abcd"), *talk(23, "z"),
    *talk(21, *"abcd", "tail of twenty-one"), *talk(22, *"abcd"), *talk(40), *talk(41, "only"), *talk(60, "only", "more"),
]
ODD = [
    (None, 0, "user", "no id"), (None, None, None, None), (None, 0, "user", "no id"), (-5, 1, "user", "below zero"), (0, 3, "user", "x  y"),
    (0, None, "user", "first"), (0, 3, None, "b"), (4, 0, "user", ""), (4, 0, "user", ""), (10, 7, "user", "a b c\td"), *FORKS,
]


@pytest.mark.parametrize("rows", [FORKS, ODD, talk(3, "alone", "with", "itself", "a", "b"), talk(4, "x")])
def test_small_tables(spark, rows):
    assert nodes_of(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert nodes_of(spark, []) == Counter()


def test_many_copies_and_a_very_long_conversation(spark, monkeypatch):
    # Small blocks and pieces, so that sums and ids go over several of them.
    monkeypatch.setattr(prefix_trie, "_BLOCK", 7)
    monkeypatch.setattr(prefix_trie, "_PIECE_BYTES", 50)
    rows = [x for c in range(0, 600, 3) for x in talk(c, "hello there", "what is it", "nothing")]
    rows += talk(1001, *map(str, range(300))) + talk(1002, *map(str, range(280)), "other", "end") + talk(1000, *"012")
    assert nodes_of(spark, rows) == brute(rows)


def test_random_tries(spark):
    import random

    draw = random.Random(4)
    rows = [x for c in range(150) for x in talk(c * 2, *(draw.choice("ab") for _ in range(draw.randrange(1, 9))))]
    assert nodes_of(spark, rows) == brute(rows)
