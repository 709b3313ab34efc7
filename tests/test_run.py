"""Whole runs over a folder: every outcome is a record."""

import pytest
from documents import playlist, rows, three_slices, track, write_slice
from pyspark.sql import functions as F

from flatloom.plans.run import expected_table_counts, run_folder, timed_run
from flatloom.schemas import PLAYLISTS, RUN_RESULT
from flatloom.sinks.tables import append_run_results, read_run_results, read_tables
from flatloom.sources.documents import read_documents


@pytest.fixture
def folder(tmp_path):
    return str(three_slices(tmp_path / "in"))


def result(record):
    row = record.first()
    return (row.status, row.slices, row.artists, row.albums, row.tracks, row.playlists, row.playlist_tracks)


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_ok(spark, folder, tmp_path, way):
    record = run_folder(spark, folder, str(tmp_path / "out"), PLAYLISTS, way)
    assert result(record) == ("OK", 3, 2, 3, 3, 5, 7)
    assert record.schema.fieldNames() == RUN_RESULT.fieldNames()
    row = record.first()
    assert row.loader == f"{way}_min"
    assert row.total_s == round(row.load_s + row.constraints_s, 1)
    assert rows(read_tables(spark, str(tmp_path / "out"), PLAYLISTS)["artists"]) == [
        ("ar:1", "name of ar:1"),
        ("ar:2", "name of ar:2"),
    ]


def test_first_slices(spark, folder, tmp_path):
    record = run_folder(spark, folder, str(tmp_path / "out"), PLAYLISTS, limit=2, rule="first_slice")
    assert result(record) == ("OK", 2, 2, 3, 3, 4, 4)
    streamed = run_folder(spark, folder, str(tmp_path / "stream"), PLAYLISTS, "stream", "first_slice", limit=2)
    assert result(streamed) == ("OK", 2, 2, 3, 3, 4, 4)
    for table, df in read_tables(spark, str(tmp_path / "out"), PLAYLISTS).items():
        assert rows(df) == rows(read_tables(spark, str(tmp_path / "stream"), PLAYLISTS)[table])


def test_first_slices_of_one_number(spark, tmp_path):
    """Files with the same first key are told apart by their path, in a stream as in a batch."""
    for name, pid in (("a", 1), ("b", 2), ("c", 3)):
        write_slice(tmp_path / "in" / name, 0, [playlist(pid, [])])
    for way in ("batch", "stream"):
        run_folder(spark, str(tmp_path / "in"), str(tmp_path / way), PLAYLISTS, way, limit=2)
        assert rows(read_tables(spark, str(tmp_path / way), PLAYLISTS)["playlists"], "pid") == [(1,), (2,)]


def test_two_documents_in_a_file_are_a_failed_load(spark, folder, tmp_path, caplog):
    one = write_slice(tmp_path / "other", 7000, [playlist(7000, [])]).read_text()
    (tmp_path / "in" / "slice.7000-7999.json").write_text(one + one.replace("7000", "7001"))
    for way in ("batch", "stream"):
        assert run_folder(spark, folder, str(tmp_path / way), PLAYLISTS, way).first().status == "LOAD_FAILED"
    assert "not exactly one JSON document" in caplog.text


def test_a_stopped_stream_is_taken_up_again(spark, folder, tmp_path, monkeypatch):
    """The second of three batches is lost; the next run loads what is missing and nothing twice."""
    from flatloom.streaming import ingest as module

    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    original, calls = module.load_batch, []

    def killed(docs, store, batch):
        calls.append(batch)
        if len(calls) == 2:
            store.write(batch, {"playlist_tracks": store.tables()["playlist_tracks"]})
            raise RuntimeError("executor gone")
        original(docs, store, batch)

    monkeypatch.setattr(module, "load_batch", killed)
    stopped = run_folder(spark, folder, target, PLAYLISTS, "stream", files_per_batch=1, state=state)
    assert stopped.first().status == "LOAD_FAILED"
    assert calls == ["run-0", "run-1"]
    again = run_folder(spark, folder, target, PLAYLISTS, "stream", files_per_batch=1, state=state)
    assert result(again) == ("OK", 3, 2, 3, 3, 5, 7)
    assert calls == ["run-0", "run-1", "run-1", "run-2"]


def test_batches_by_bytes(spark, folder, tmp_path):
    record = run_folder(spark, folder, str(tmp_path / "out"), PLAYLISTS, "stream", bytes_per_batch=1000)
    assert result(record) == ("OK", 3, 2, 3, 3, 5, 7)


def test_failures_are_records_too(spark, folder, tmp_path):
    out, results = str(tmp_path / "out"), str(tmp_path / "results")
    write_slice(tmp_path / "in", 3000, [playlist(0, [track(0, "tr:a")])])
    twice = run_folder(spark, folder, out, PLAYLISTS)
    assert result(twice) == ("CONSTRAINTS_FAILED", 4, 0, 0, 0, 0, 0)
    (tmp_path / "in" / "slice.4000-4999.json").write_text('{"playlists": [{"pid": 4000, "tr')
    broken = run_folder(spark, folder, out, PLAYLISTS, rep=2)
    assert result(broken) == ("LOAD_FAILED", 5, 0, 0, 0, 0, 0)
    for record in (twice, broken):
        append_run_results(record, results)
    found = read_run_results(spark, results)
    assert rows(found, "rep", "status", "rows_per_s") == [(1, "CONSTRAINTS_FAILED", 0), (2, "LOAD_FAILED", 0)]


def test_mismatch(spark, folder, tmp_path):
    def docs(parent_fields=None, entry_fields=()):
        return read_documents(spark, folder, PLAYLISTS, "file", parent_fields, entry_fields)

    from flatloom.plans.normalize import load

    expected = expected_table_counts(docs, PLAYLISTS)
    assert rows(expected) == [("albums", 3), ("artists", 2), ("playlist_tracks", 7), ("playlists", 5), ("tracks", 3)]

    def lossy():
        tables = load(docs(), PLAYLISTS, str(tmp_path / "out"))
        return tables | {"playlist_tracks": tables["playlist_tracks"].filter("pos < 2")}

    assert result(timed_run(spark, "lossy", PLAYLISTS, expected, lossy)) == ("MISMATCH", 0, 2, 3, 3, 5, 6)


def test_ways(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="way"):
        run_folder(spark, folder, str(tmp_path), PLAYLISTS, way="queue")
    with pytest.raises(ValueError, match="slice files"):
        run_folder(spark, folder, str(tmp_path), PLAYLISTS, layout="lines", limit=1)


def test_violated_rules_and_other_failures_are_logged(spark, folder, tmp_path, caplog):
    write_slice(tmp_path / "in", 3000, [playlist(0, [track(0, "tr:a")])])
    assert run_folder(spark, folder, str(tmp_path / "out"), PLAYLISTS).first().status == "CONSTRAINTS_FAILED"
    assert "primary_key playlists(pid): 1" in caplog.text

    def damaged():
        tables = read_tables(spark, str(tmp_path / "out"), PLAYLISTS)
        return tables | {"artists": tables["artists"].withColumn("name", F.raise_error(F.lit("gone")).cast("string"))}

    expected = spark.createDataFrame([], "tbl string, n long")
    assert timed_run(spark, "damaged", PLAYLISTS, expected, damaged).first().status == "CONSTRAINTS_FAILED"
    assert "gone" in caplog.text
