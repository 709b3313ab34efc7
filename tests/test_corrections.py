"""A slice delivered again replaces its older version, and nothing else changes."""

import json
import shutil

import pytest
from documents import playlist, rows, track, write_slice
from pyspark.sql import functions as F

import flatloom.queries.corrections as queries
from flatloom.plans.corrections import CorrectableStore, deliver, entry_count_mismatch, parse_slices, publish
from flatloom.plans.normalize import constraint_report, normalize
from flatloom.schemas import PLAYLISTS
from flatloom.scratch import written
from flatloom.sources.documents import read_documents
from flatloom.sources.star_schema import ORDERS

A = track(0, "tr:a", "b name", album="al:1", artist="ar:1")
B = track(1, "tr:b", "b", album="al:2", artist="ar:2")


def slices(folder, **changes):
    """Three slices; ``changes`` replaces some, or leaves one out."""
    given = {
        "s0": [playlist(0, [A, B]), playlist(1, [])],
        "s2000": [playlist(2000, [{**A, "track_name": "a name", "pos": 1}]), playlist(2001)],
        "s10000": [playlist(10000, [{**B, "pos": 0}, track(1, "tr:c", album="al:2", artist="ar:2")])],
    } | changes
    for name, playlists in given.items():
        if playlists is not None:
            write_slice(folder, int(name[1:]), playlists)
    return str(folder)


def same(spark, store, folder, rule):
    """The store against a load of the slices that stand."""
    expected = normalize(read_documents(spark, folder, PLAYLISTS), PLAYLISTS, rule)
    found = store.tables()
    for name in PLAYLISTS.tables:
        assert rows(found[name]) == rows(expected[name]), name
    assert entry_count_mismatch(store).collect() == []


def outcomes(store, delivery):
    return {r.slice_start: r.outcome for r in store.outcomes().filter(f"delivery = {delivery}").collect()}


@pytest.mark.parametrize("rule", ["min", "smallest", "first_slice"])
def test_equal_to_a_load_of_the_last_versions(spark, tmp_path, rule):
    store = CorrectableStore(spark, str(tmp_path / "store"), PLAYLISTS, rule)
    store.create()
    first = slices(tmp_path / "1")
    deliver(read_documents(spark, first, PLAYLISTS), store, 1)
    same(spark, store, first, rule)
    assert outcomes(store, 1) == {0: "new", 2000: "new", 10000: "new"}
    # The smaller name goes, a playlist loses its entry, another slice comes as it was.
    corrected = [playlist(2000, []), playlist(2002, [{**B, "track_name": "z", "pos": 0}])]
    part = slices(tmp_path / "2", s2000=corrected, s10000=None)
    deliver(read_documents(spark, part, PLAYLISTS), store, 2)
    assert outcomes(store, 2) == {0: "unchanged", 2000: "corrected"}
    same(spark, store, slices(tmp_path / "2-all", s2000=corrected), rule)
    # A track that no slice has any more, and a new slice.
    third = dict(s10000=[playlist(10000, [{**B, "pos": 0}])], s3000=[playlist(3000, [track(0, "tr:d", album="al:9", artist="ar:9")])])
    deliver(read_documents(spark, slices(tmp_path / "3", s0=None, s2000=None, **third), PLAYLISTS), store, 3)
    everything = slices(tmp_path / "3-all", s2000=corrected, **third)
    same(spark, store, everything, rule)
    assert "tr:c" not in {r[0] for r in rows(store.tables()["tracks"], "track_uri")}
    # Back to the first version: the key that was gone is there again.
    deliver(read_documents(spark, first, PLAYLISTS), store, 4)
    same(spark, store, slices(tmp_path / "4-all", s3000=third["s3000"]), rule)
    published = publish(store, str(tmp_path / "target"))
    assert constraint_report(published, PLAYLISTS).filter("violations > 0").collect() == []


def test_last_write_over_all_slices(spark, tmp_path):
    store = CorrectableStore(spark, str(tmp_path / "store"), PLAYLISTS, "last")
    store.create()
    deliver(read_documents(spark, slices(tmp_path / "1"), PLAYLISTS), store, 1)
    names = lambda: dict(rows(store.tables()["tracks"], "track_uri", "name"))
    assert names() == {"tr:a": "a name", "tr:b": "b", "tr:c": "name of tr:c"}
    late = [playlist(10000, [{**A, "track_name": "late"}])]
    deliver(read_documents(spark, slices(tmp_path / "2", s0=None, s2000=None, s10000=late), PLAYLISTS), store, 2)
    assert names() == {"tr:a": "late", "tr:b": "b"}


def test_only_touched_keys_are_written(spark, tmp_path):
    store = CorrectableStore(spark, str(tmp_path / "store"), PLAYLISTS)
    store.create()
    deliver(read_documents(spark, slices(tmp_path / "1"), PLAYLISTS), store, 1)
    corrected = [playlist(2000, [{**A, "track_name": "c name", "pos": 0}])]
    deliver(read_documents(spark, slices(tmp_path / "2", s2000=corrected), PLAYLISTS), store, 2)
    written = spark.read.parquet(str(tmp_path / "store/winners/tracks/delivery=2"))
    assert rows(written, "track_uri", "name", "gone") == [("tr:a", "b name", False)]
    assert rows(spark.read.parquet(str(tmp_path / "store/playlists/delivery=2")), "pid") == [(2000,)]


def test_a_delivery_again_and_one_that_was_cut_short(spark, tmp_path):
    store = CorrectableStore(spark, str(tmp_path / "store"), PLAYLISTS)
    store.create()
    first = slices(tmp_path / "1")
    deliver(read_documents(spark, first, PLAYLISTS), store, 1)
    other = slices(tmp_path / "2", s0=[playlist(0, [{**A, "track_name": "0"}])])
    # The same number brings nothing new.
    deliver(read_documents(spark, other, PLAYLISTS), store, 1)
    same(spark, store, first, "min")
    # All is written but the log: nothing of it shows.
    deliver(read_documents(spark, other, PLAYLISTS), store, 2)
    shutil.rmtree(tmp_path / "store/load_log/delivery=2")
    same(spark, store, first, "min")
    deliver(read_documents(spark, slices(tmp_path / "3", s2000=[playlist(2000)]), PLAYLISTS), store, 3)
    same(spark, store, slices(tmp_path / "3-all", s2000=[playlist(2000)]), "min")
    # Winners of a later delivery stand on what was there: an earlier number would come too late.
    with pytest.raises(ValueError, match="new number"):
        deliver(read_documents(spark, other, PLAYLISTS), store, 2)
    deliver(read_documents(spark, other, PLAYLISTS), store, 4)
    assert dict(rows(store.tables()["tracks"], "track_uri", "name"))["tr:a"] == "0"


def test_no_documents_and_a_wrong_rule(spark, tmp_path):
    store = CorrectableStore(spark, str(tmp_path / "store"), PLAYLISTS)
    store.create()
    deliver(read_documents(spark, slices(tmp_path / "1"), PLAYLISTS).limit(0), store, 1)
    assert all(t.count() == 0 for t in store.tables().values())
    with pytest.raises(ValueError, match="rule"):
        CorrectableStore(spark, "x", PLAYLISTS, "none")


def order(pid, name):
    entries = [{"pos": p, "track_key": pid, "track_name": name, "album_key": 1, "album_name": "al", "artist_key": 2, "artist_name": "ar"} for p in (0, 1)]
    return {"pid": pid, "name": "n", "collaborative": "true", "modified_at": 1, "part": 0, "tracks": entries}


def test_three_deliveries_parse_the_text_once(spark, tmp_path, monkeypatch):
    text = tmp_path / "text" / "documents.json"
    text.parent.mkdir()
    text.write_text("".join(json.dumps({"playlists": [order(n * 1000, f"name {n}")]}) + "\n" for n in range(12)))
    owned = []

    def documents(spark, sf_dir):
        # What is staged here belongs to the session, not to the query.
        owned.append(written(spark.range(3), "staged"))
        return read_documents(spark, str(text.parent), ORDERS, "lines")

    monkeypatch.setattr(queries, "documents", documents)

    def then_broken(docs, store, delivery):
        deliver(docs, store, delivery)
        text.write_text("broken")

    monkeypatch.setattr(queries, "deliver", then_broken)
    store = queries._delivered_three_times(spark, str(tmp_path), "min")
    assert outcomes(store, 1) == dict.fromkeys(range(12), "new")
    assert outcomes(store, 2) == dict.fromkeys((1, 4, 7, 10), "corrected")
    assert outcomes(store, 3) == dict.fromkeys((4, 10), "corrected") | dict.fromkeys((3, 11), "unchanged")
    assert owned[0].count() == 3
    tables = store.tables()
    bad = (1, 7)
    assert rows(tables["tracks"], "track_key", "name") == rows(
        spark.createDataFrame([(n * 1000, f"{'!' * (n in bad)}name {n}") for n in range(12)], "k long, name string")
    )
    assert rows(tables["playlist_tracks"], "pid", "pos") == rows(
        spark.createDataFrame([(n * 1000, p) for n in range(12) for p in (0, 1) if p or n not in bad], "pid long, pos int")
    )


@pytest.mark.parametrize("rule", ["min", "smallest", "first_slice", "last"])
def test_written_parents_are_delivered_whole_or_in_part(spark, tmp_path, rule):
    store = CorrectableStore(spark, str(tmp_path / "store"), PLAYLISTS, rule)
    store.create()
    folder = slices(tmp_path / "1")
    # A file whose name has no number, an entry without a key, and a copy.
    nameless = [playlist(9, [{**A, "track_uri": None, "track_name": None}, {**A, "track_uri": None, "track_name": None, "pos": 1}])]
    (tmp_path / "1" / "slice.5x-6.json").write_text(json.dumps({"playlists": nameless}))
    parsed = parse_slices(read_documents(spark, folder, PLAYLISTS), store)
    deliver(parsed.part(F.col("slice_start") < 10000), store, 1)
    assert outcomes(store, 1) == {-1: "new", 0: "new", 2000: "new"}
    deliver(parsed, store, 2)
    assert outcomes(store, 2) == {-1: "unchanged", 0: "unchanged", 2000: "unchanged", 10000: "new"}
    # Documents have the same content as the parents written from them.
    deliver(read_documents(spark, folder, PLAYLISTS), store, 3)
    assert set(outcomes(store, 3).values()) == {"unchanged"}
    assert len(rows(store.tables()["playlist_tracks"])) == 7
    assert rows(store.tables()["tracks"], "track_uri", "name")[-1] == (None, None)
