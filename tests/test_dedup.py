"""The winner rules: the same on clean input, different in the documented way on conflicting input."""

import pytest
from documents import playlist, rows, three_slices, track, write_slice
from hypothesis import given, settings
from hypothesis import strategies as st

from flatloom.operators import dedup
from flatloom.plans.normalize import normalize
from flatloom.schemas import PLAYLISTS
from flatloom.sources.documents import read_documents

RULES = ["min", "smallest", "any", "first_slice", "last"]


def test_rules_agree_on_clean_input(spark, tmp_path):
    docs = read_documents(spark, str(three_slices(tmp_path)), PLAYLISTS)
    results = [{t: rows(df) for t, df in normalize(docs, PLAYLISTS, rule).items()} for rule in RULES]
    assert all(r == results[0] for r in results)
    assert results[0]["albums"] == [
        ("al:1", "name of al:1", "ar:1"),
        ("al:2", "name of al:2", "ar:1"),
        ("al:3", "name of al:3", "ar:2"),
    ]
    assert results[0]["tracks"][1] == ("tr:b", "name of tr:b", "al:2", 2000)


@pytest.fixture
def conflicting(tmp_path):
    """One track with a name that changes within slice 0 and again in slice 2000 and 10000."""
    write_slice(
        tmp_path,
        0,
        [
            playlist(0, [track(0, "t", "m", album="al:5", duration=9)]),
            playlist(1, [track(0, "t", "k", album="al:9", duration=8)]),
        ],
    )
    write_slice(tmp_path, 2000, [playlist(2000, [track(0, "t", "z", album="al:0", duration=1)])])
    write_slice(tmp_path, 10000, [playlist(10000, [track(0, "t", "b", album="al:7", duration=5)])])
    return str(tmp_path)


def test_rules_differ_on_conflicting_input(spark, conflicting):
    docs = read_documents(spark, conflicting, PLAYLISTS)
    track_rows = {rule: rows(normalize(docs, PLAYLISTS, rule)["tracks"]) for rule in RULES}
    # Columns from three different rows.
    assert track_rows["min"] == [("t", "b", "al:0", 1)]
    # A row that exists.
    assert track_rows["smallest"] == [("t", "b", "al:7", 5)]
    # Slice 0 comes first, by number; in it, the last write stands.
    assert track_rows["first_slice"] == [("t", "k", "al:9", 8)]
    # Of all writes the last one, slices by number.
    assert track_rows["last"] == [("t", "b", "al:7", 5)]
    assert track_rows["any"][0] in {("t", "m", "al:5", 9), ("t", "k", "al:9", 8), ("t", "z", "al:0", 1), ("t", "b", "al:7", 5)}


def test_album_with_two_artists(spark, tmp_path):
    a = track(0, "x", album="al", album_name="n", artist="ar:2")
    b = track(1, "y", album="al", album_name="n", artist="ar:1")
    write_slice(tmp_path, 0, [playlist(0, [a, b])])
    docs = read_documents(spark, str(tmp_path), PLAYLISTS)
    assert rows(normalize(docs, PLAYLISTS, "min")["albums"]) == [("al", "n", "ar:1")]
    assert rows(normalize(docs, PLAYLISTS, "first_slice")["albums"]) == [("al", "n", "ar:1")]


WRITES = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from("abc"), st.sampled_from(["p", "q", "r", None]), st.integers(0, 9)),
    min_size=1,
    max_size=40,
)


@settings(max_examples=8, deadline=None)
@given(WRITES)
def test_rules_against_brute_force(spark, writes):
    """Rows are (slice, key, name, size); the place in the list is the order of the writes."""
    data = [(s, i, k, n, z) for i, (s, k, n, z) in enumerate(writes)]
    df = spark.createDataFrame(data, "slice int, place int, key string, name string, size int")

    in_slice: dict = {}
    for s, _, k, n, z in data:
        in_slice[s, k] = (n, z)
    found = rows(dedup.last_write_wins(df, ["slice", "key"], ["name", "size"], ["place"]))
    assert found == sorted(((s, k, *v) for (s, k), v in in_slice.items()), key=lambda r: (str(r[0]), r[1]))

    stored: dict = {}
    for (s, k), v in sorted(in_slice.items(), key=lambda item: item[0][0]):
        stored.setdefault(k, v)
    expected = sorted((k, *v) for k, v in stored.items())
    assert rows(dedup.first_slice_wins(df, "key", ["name", "size"], "slice", ["place"])) == expected
    # An order by text goes the same way.
    by_text = df.selectExpr("*", "lpad(string(place), 5, '0') as at")
    assert rows(dedup.first_slice_wins(by_text, "key", ["name", "size"], "slice", ["at"])) == expected

    first: dict = {}
    for _, _, k, n, z in data:
        first.setdefault(k, (n, z))
    assert rows(dedup.first_row(df, "key", ["name", "size"], ["place"])) == sorted((k, *v) for k, v in first.items())

    lows = {k: (min((n for _, _, a, n, _ in data if a == k and n is not None), default=None),
                min(z for _, _, a, _, z in data if a == k)) for k in first}
    assert rows(dedup.min_per_column(df, "key", ["name", "size"])) == sorted((k, *v) for k, v in lows.items())


def test_new_keys_and_rows(spark):
    known = spark.createDataFrame([("a", 1), ("b", 1)], "key string, v int")
    incoming = spark.createDataFrame([("b", 9), ("c", 3), ("c", 2), ("d", 4)], "key string, v int")
    assert rows(dedup.new_keys(incoming, known, "key")) == [("c",), ("d",)]
    assert rows(dedup.new_rows(incoming, known, "key", ["v"])) == [("c", 2), ("d", 4)]
    assert rows(dedup.any_row(incoming, "key", ["v"], deterministic=True)) == [("b", 9), ("c", 2), ("d", 4)]
    assert dedup.any_row(incoming, "key", ["v"], deterministic=False).count() == 3


def test_unknown_rule(spark, tmp_path):
    docs = read_documents(spark, str(three_slices(tmp_path)), PLAYLISTS)
    with pytest.raises(ValueError, match="rule"):
        normalize(docs, PLAYLISTS, "best")


def test_rows_of_later_slices_are_not_sorted(spark, monkeypatch):
    """Only rows of the earliest slice of a key meet the sort; with many keys all rows do, with the same winners."""
    data = [(k, s, p, f"{k} {s} {p}") for k in (None, 1, 2, 3) for s in (None, 4, 5) for p in (None, 0, 7) if k != 2 or s is None]
    df = spark.createDataFrame(data, "key int, slice int, place int, name string")
    found = dedup.first_slice_wins(df, "key", ["name"], "slice", ["place"])
    plan = found._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    expected = [(1, "1 4 7"), (2, "2 None 7"), (3, "3 4 7"), (None, "None 4 7")]
    assert rows(found) == expected
    monkeypatch.setattr(dedup, "FEW_KEYS", 3)
    assert rows(dedup.first_slice_wins(df, "key", ["name"], "slice", ["place"])) == expected


def test_copies_go_before_rows_are_sorted(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None), (None, "c"), (None, "c")], "k long, name string").write.parquet(path)
    found = dedup.min_per_column(spark.read.parquet(path), "k", ["name"], distinct_first=True)
    assert rows(found) == [(1, "a"), (2, None), (None, "c")]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("SortAggregate") < plan.index("HashAggregate")
