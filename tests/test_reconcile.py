"""Differences by value: found from digests, named row by row, read from differing slices alone."""

import shutil
from collections import Counter
from pathlib import Path

import pytest

from flatloom.operators import digests
from flatloom.operators.checks import CheckFailed
from flatloom.plans.reconcile import (
    require_same_values,
    rows_that_differ,
    slices_that_differ,
    write_sliced,
)
from flatloom.sources.star_schema import ORDERS

SCHEMA = "slice long, k long, a string, b double"


def leaves(spark, rows):
    return digests.slice_digests(spark.createDataFrame(rows, SCHEMA), "slice")


def differing(spark, left, right):
    found = digests.differing_slices(*(digests.digest_tree(leaves(spark, x)) for x in (left, right)))
    return {r.slice: (r.n_left, r.n_right) for r in found.collect()}


def test_digests_see_values_nulls_and_copies_but_no_order(spark):
    rows = [(1, 1, "x", 1.0), (1, 2, None, 2.0), (1, 2, None, 2.0), (2, 3, "y", None), (700, 4, "z", 4.0)]
    assert differing(spark, rows, rows[::-1]) == {}
    assert differing(spark, rows, [*rows, rows[0]]) == {1: (3, 4)}
    # The number of rows stays, the values differ.
    assert differing(spark, rows, [rows[0], rows[0], rows[1], *rows[3:]]) == {1: (3, 3)}
    # NULL and a value change places.
    assert differing(spark, [(5, None, "7", 1.0)], [(5, 7, None, 1.0)]) == {5: (1, 1)}
    assert differing(spark, [(5, 1, None, 1.0)], [(5, 1, "", 1.0)]) == {5: (1, 1)}
    assert differing(spark, rows, rows[:4]) == {700: (1, None)}
    assert differing(spark, [], []) == {}
    assert differing(spark, [], rows[3:]) == {2: (None, 1), 700: (None, 1)}


def test_a_row_in_the_wrong_slice(spark):
    assert differing(spark, [(1, 1, "x", 1.0), (9, 2, "y", 1.0)], [(9, 1, "x", 1.0), (9, 2, "y", 1.0)]) == {
        1: (1, None),
        9: (1, 2),
    }


def test_slices_far_apart_and_below_zero(spark):
    far = [0, 63, 64, 4095, 4096, 64**3, 64**4 + 5, -1, -65]
    rows = [(s, i, "v", 1.0) for i, s in enumerate(far)]
    wrong = {63, 4096, 64**4 + 5, -1}
    other = [(s, i, "w" if s in wrong else "v", 1.0) for s, i, _, _ in rows]
    assert differing(spark, rows, other) == {s: (1, 1) for s in wrong}


def rows_of(spark, left, right, key=("k",)):
    sides = (spark.createDataFrame(x, SCHEMA) for x in (left, right))
    return {
        tuple(r[c] for c in key): (r.kind, r.n_left, r.n_right, r["columns"])
        for r in digests.differing_rows(*sides, list(key)).collect()
    }


def test_rows_are_named(spark):
    left = [(1, 1, "x", 1.0), (1, 2, None, 2.0), (1, 3, "c", 3.0), (1, 4, "d", 4.0), (1, 4, "d", 4.0), (1, None, "n", 0.0)]
    right = [(1, 1, "x", 9.0), (1, 2, "", 2.5), (1, 4, "d", 4.0), (1, 5, "e", None), (1, None, "m", 0.0)]
    assert rows_of(spark, left, right) == {
        (1,): ("changed", 1, 1, ["b"]),
        (2,): ("changed", 1, 1, ["a", "b"]),
        (3,): ("missing", 1, 0, None),
        (4,): ("missing", 1, 0, None),
        (5,): ("added", 0, 1, None),
        (None,): ("changed", 1, 1, ["a"]),
    }
    assert rows_of(spark, left, left[::-1]) == {}
    assert rows_of(spark, [], []) == {}


def test_a_key_with_several_rows(spark):
    left = [(1, 1, x, 1.0) for x in "abcc"]
    right = [(1, 1, x, 1.0) for x in "abxyz"]
    found = digests.differing_rows(*(spark.createDataFrame(x, SCHEMA) for x in (left, right)), ["k"]).collect()
    assert [(r.kind, r.n_left, r.n_right, r["columns"]) for r in found] == [("changed", 2, 3, None)]
    assert '"a":"c"' in found[0].left_row and '"a":"x"' in found[0].right_row


def test_all_columns_in_the_key(spark):
    found = rows_of(spark, [(1, 1, "x", 1.0)], [(1, 1, "x", 2.0)], ("slice", "k", "a", "b"))
    assert found == {(1, 1, "x", 1.0): ("missing", 1, 0, None), (1, 1, "x", 2.0): ("added", 0, 1, None)}


@pytest.fixture
def copies(spark, tmp_path):
    """Two sliced copies that differ in one slice of the facts and in one artist."""

    def tables(track, name):
        rows = {
            "artists": [(i, name if i == 7 else f"artist {i}") for i in range(40)],
            "albums": [(i, f"album {i}", i % 40) for i in range(60)],
            "tracks": [(i, f"track {i}", i % 60) for i in range(100)],
            "playlists": [(pid, f"list {pid}", None, pid % 2 == 0, None) for pid in range(0, 10_000, 250)],
            "playlist_tracks": [
                (pid, pos, track if (pid, pos) == (5250, 3) else pos) for pid in range(0, 10_000, 250) for pos in range(5)
            ],
        }
        return {t: spark.createDataFrame(r, ORDERS.table_schema(t)) for t, r in rows.items()}

    roots = str(tmp_path / "left"), str(tmp_path / "right")
    for root, found in zip(roots, (tables(3, "right"), tables(99, "wrong")), strict=True):
        write_sliced(found, root, ORDERS)
    return roots


def test_copies(spark, copies):
    found = slices_that_differ(spark, *copies, ORDERS).collect()
    assert {(r.tbl, r.slice) for r in found if r.tbl != "artists"} == {("playlist_tracks", 5)}
    assert Counter(r.tbl for r in found) == {"artists": 1, "playlist_tracks": 1}
    rows = {(r.tbl, r.key): (r.kind, r["columns"]) for r in rows_that_differ(spark, *copies, ORDERS).collect()}
    assert rows == {
        ("playlist_tracks", '{"pid":5250,"pos":3}'): ("changed", ["track_key"]),
        ("artists", '{"artist_key":7}'): ("changed", ["name"]),
    }
    with pytest.raises(CheckFailed, match="5250"):
        require_same_values(spark, *copies, ORDERS)
    require_same_values(spark, copies[0], copies[0], ORDERS)


def test_only_differing_slices_are_read(spark, copies):
    """The files of the other slices are spoiled: a scan that opened one would fail."""
    wanted = {(r.tbl, r.slice) for r in slices_that_differ(spark, *copies, ORDERS).collect()}
    spoiled = 0
    for root in copies:
        for folder in Path(root).glob("*/slice=*"):
            if (folder.parent.name, int(folder.name.split("=")[1])) not in wanted:
                for file in folder.glob("*.parquet"):
                    file.write_bytes(b"spoiled")
                    (folder / f".{file.name}.crc").unlink(missing_ok=True)
                    spoiled += 1
    assert spoiled > 100
    assert rows_that_differ(spark, *copies, ORDERS).count() == 2


def test_digests_follow_what_is_stored(spark, copies):
    """A slice that is lost after it was written shows once the digests are taken again."""
    from flatloom.plans.reconcile import write_digests

    shutil.rmtree(next(Path(copies[0]).glob("playlist_tracks/slice=2")))
    write_digests(spark, copies[0], ORDERS, "playlist_tracks")
    found = {r.slice: (r.n_left, r.n_right) for r in slices_that_differ(spark, *copies, ORDERS).collect() if r.tbl == "playlist_tracks"}
    assert found == {2: (None, 20), 5: (20, 20)}
