"""Checks find what was planted, and nothing else."""

import pytest
from documents import playlist, rows, three_slices, track, write_slice
from pyspark.sql import functions as F

from flatloom.operators import checks, counts
from flatloom.plans.normalize import constraint_report, normalize
from flatloom.schemas import PLAYLISTS
from flatloom.sources.documents import read_documents


def test_clean_tables_pass(spark, tmp_path):
    docs = read_documents(spark, str(three_slices(tmp_path)), PLAYLISTS)
    report = constraint_report(normalize(docs, PLAYLISTS), PLAYLISTS)
    assert report.filter("violations > 0").count() == 0
    kinds = {r["kind"]: r["n"] for r in report.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    # 22 of the 23 columns are required; five keys, four references.
    assert kinds == {"not_null": 22, "primary_key": 5, "foreign_key": 4}
    checks.require_empty(report.filter("violations > 0"), "constraints")


def test_planted_violations_are_found(spark, tmp_path):
    nameless = {**track(1, "tr:n"), "track_name": None}
    write_slice(tmp_path, 0, [playlist(0, [track(0, "tr:a"), nameless, track(1, "tr:a")], collaborative=None)])
    tables = normalize(read_documents(spark, str(tmp_path), PLAYLISTS), PLAYLISTS)
    stray = spark.createDataFrame([(99, 0, "tr:a"), (0, 7, "tr:gone")], "pid int, pos int, track_uri string")
    tables["playlist_tracks"] = tables["playlist_tracks"].unionByName(stray)
    found = constraint_report(tables, PLAYLISTS).filter("violations > 0")
    assert rows(found) == [
        ("foreign_key", "playlist_tracks.pid -> playlists", 1),
        ("foreign_key", "playlist_tracks.track_uri -> tracks", 1),
        ("not_null", "playlists.collaborative", 1),
        ("not_null", "tracks.name", 1),
        ("primary_key", "playlist_tracks(pid, pos)", 1),
    ]
    with pytest.raises(checks.CheckFailed, match="tracks.name"):
        checks.require_empty(found, "constraints")


def test_null_keys_violate_primary_but_not_foreign_keys(spark):
    child = spark.createDataFrame([(1,), (None,), (2,), (2,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(checks.key_violations(child, ["k"])) == [(2, 2), (None, 1)]
    assert rows(checks.orphan_keys(child, "k", parent, "k")) == [(2, 2)]


def test_dependencies(spark):
    data = [(1, "a", 1), (1, "a", 1), (2, "a", 1), (2, "a", 2), (3, None, 1), (3, "a", 1)]
    df = spark.createDataFrame(data, "k int, a string, b int")
    assert rows(checks.dependency_violations(df, "k", ["a", "b"])) == [(2, 2), (3, 2)]
    assert rows(checks.broken_dependencies(df, "k", ["a", "b"])) == [(2,), (3,)]
    # A single column follows count(distinct), which does not count NULL.
    assert rows(checks.dependency_violations(df, "k", ["b"])) == [(2, 2)]


def test_reconciliation(spark):
    expected = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "tbl string, n long")
    actual = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4)], "tbl string, n long")
    assert rows(checks.mismatches(expected, actual)) == [("b", 2, 3), ("c", 3, None)]


def test_status_shows_the_first_failure(spark):
    df = spark.createDataFrame([(f, c, m) for f in (0, 1) for c in (0, 1) for m in (0, 1)], "f int, c int, m int")
    status = checks.load_status(F.col("f") == 1, F.col("c") == 1, F.col("m") == 1)
    found = {(r.f, r.c, r.m): r.s for r in df.withColumn("s", status).collect()}
    assert found[0, 0, 0] == "OK"
    assert found[0, 0, 1] == "MISMATCH"
    assert found[0, 1, 1] == "CONSTRAINTS_FAILED"
    assert {v for (f, _, _), v in found.items() if f} == {"LOAD_FAILED"}


def test_expected_counts_from_documents(spark, tmp_path):
    from flatloom.operators.flatten import wide_entries

    wide = wide_entries(read_documents(spark, str(three_slices(tmp_path)), PLAYLISTS), PLAYLISTS)
    found = counts.expected_counts(wide, {"tracks": "track_uri", "albums": "album_uri", "artists": "artist_uri"})
    assert rows(found) == [(7, 3, 3, 2)]
    assert rows(counts.duplication(wide, "track_uri")) == [(7, 3, 7 / 3)]
    assert [tuple(r) for r in counts.hottest_keys(wide, "track_uri", 2).collect()] == [("tr:c", 3), ("tr:a", 2)]
    assert rows(counts.parents_containing(wide, "track_uri", "tr:c", "pid")) == [(10000,), (2000,)]
