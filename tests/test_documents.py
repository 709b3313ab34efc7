"""Reading, flattening and typing hand-made documents."""

import datetime

import pytest
from documents import playlist, rows, three_slices, track, write_slice
from pyspark.sql import functions as F

from flatloom.operators.flatten import (
    entries_per_parent,
    entry_rows,
    explode_parents,
    fact_rows,
    parent_rows,
    parents_without_entries,
    wide_entries,
)
from flatloom.schemas import PLAYLISTS
from flatloom.sources.documents import (
    documents_from_text,
    read_documents,
    read_with_quarantine,
)
from flatloom.sources.slices import slice_files, slice_paths


@pytest.fixture
def folder(tmp_path):
    return str(three_slices(tmp_path / "in"))


def test_slices_come_in_numeric_order(spark, folder):
    assert [r.slice_start for r in slice_files(spark, folder, 2).collect()] == [0, 2000]
    assert [p.rsplit("/", 1)[-1] for p in slice_paths(spark, folder, 3)] == [
        "slice.0-999.json",
        "slice.2000-2999.json",
        "slice.10000-10999.json",
    ]
    assert slice_paths(spark, folder) == folder


def test_first_slices_only(spark, folder):
    docs = read_documents(spark, slice_paths(spark, folder, 2), PLAYLISTS)
    assert wide_entries(docs, PLAYLISTS).count() == 4


def test_entries(spark, folder):
    wide = wide_entries(read_documents(spark, folder, PLAYLISTS), PLAYLISTS)
    assert wide.columns == ["pid", *PLAYLISTS.entry_columns]
    assert rows(fact_rows(wide, PLAYLISTS)) == [
        (0, 0, "tr:a"),
        (0, 1, "tr:b"),
        (10000, 0, "tr:b"),
        (10000, 1, "tr:c"),
        (10000, 2, "tr:c"),
        (2000, 0, "tr:c"),
        (2000, 1, "tr:a"),
    ]


def test_parents_keep_their_row_without_entries(spark, folder):
    parents = explode_parents(read_documents(spark, folder, PLAYLISTS), PLAYLISTS)
    assert rows(parent_rows(parents, PLAYLISTS), "pid") == [(0,), (1,), (10000,), (2000,), (2001,)]
    assert rows(parents_without_entries(parents, PLAYLISTS)) == [(1,), (2001,)]
    assert rows(entries_per_parent(parents, PLAYLISTS)) == [(0, 2), (1, 0), (10000, 3), (2000, 2), (2001, 0)]
    outer = entry_rows(parents, PLAYLISTS, outer=True)
    assert rows(outer.filter("track_uri is null"), "pid") == [(1,), (2001,)]


def test_ordinals_follow_the_arrays(spark, folder):
    docs = read_documents(spark, folder, PLAYLISTS)
    wide = entry_rows(explode_parents(docs, PLAYLISTS, ordinals=True), PLAYLISTS, ordinals=True)
    assert rows(wide.filter("pid = 10000"), "parent_ord", "entry_ord", "track_uri") == [
        (0, 0, "tr:b"),
        (0, 1, "tr:c"),
        (0, 2, "tr:c"),
    ]
    assert rows(wide.filter("pid = 2000"), "parent_ord", "entry_ord", "pos") == [(0, 0, 0), (0, 1, 1)]


def test_typed_parent_columns(spark, tmp_path):
    write_slice(
        tmp_path,
        0,
        [
            playlist(0, [], description="text", collaborative="true"),
            playlist(1, [], collaborative=None),
            playlist(2, [], collaborative="yes"),
        ],
    )
    parents = explode_parents(read_documents(spark, str(tmp_path), PLAYLISTS), PLAYLISTS)
    table = parent_rows(parents, PLAYLISTS)
    assert table.schema.fieldNames() == PLAYLISTS.table_schema("playlists").fieldNames()
    assert [f.dataType for f in table.schema] == [f.dataType for f in PLAYLISTS.table_schema("playlists")]
    assert rows(table, "pid", "description", "collaborative") == [
        (0, "text", True),
        (1, None, None),
        (2, None, False),
    ]
    stamp = table.filter("pid = 0").select(F.date_format("modified_at", "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert stamp == datetime.datetime.fromtimestamp(1493424000, datetime.UTC).strftime("%Y-%m-%d %H:%M:%S")
    assert table.first().duration_ms == 3_000_000_000


def test_narrow_read_converts_only_named_fields(spark, folder):
    docs = read_documents(spark, folder, PLAYLISTS, parent_fields=["pid"], entry_fields=["track_uri"])
    assert docs.schema["playlists"].dataType.elementType.fieldNames() == ["pid", "tracks"]
    assert wide_entries(docs, PLAYLISTS).columns == ["pid", "track_uri"]


def test_truncated_file_fails_the_job(spark, folder, tmp_path):
    (tmp_path / "in" / "slice.3000-3999.json").write_text('{"playlists": [{"pid": 3000, "tracks": [{"po')
    with pytest.raises(Exception, match="not exactly one JSON document"):
        wide_entries(read_documents(spark, folder, PLAYLISTS), PLAYLISTS).collect()


def test_truncated_file_goes_to_quarantine(spark, folder, tmp_path):
    (tmp_path / "in" / "slice.3000-3999.json").write_text('{"playlists": [{"pid": 3000, "tracks": [{"po')
    found = read_with_quarantine(spark, folder, PLAYLISTS)
    assert wide_entries(found.good, PLAYLISTS).count() == 7
    rejected = found.rejects.collect()
    assert [r.source_file.rsplit("/", 1)[-1] for r in rejected] == ["slice.3000-3999.json"]
    assert rejected[0].text.startswith('{"playlists"')


@pytest.mark.parametrize("damage", ["twice", "info first", "trailing", "blank"])
def test_files_with_anything_but_one_document(spark, folder, tmp_path, damage):
    one = write_slice(tmp_path / "other", 5000, [playlist(5000, [track(0, '"} {"')])]).read_text()
    headed = '{"info": {"version": 1}, ' + one.lstrip()[1:]
    text = {"twice": one + "\n" + one, "info first": headed + headed, "trailing": one + " end", "blank": " "}[damage]
    bad = tmp_path / "in" / "slice.5000-5999.json"
    bad.write_text(text)
    with pytest.raises(Exception, match="not exactly one JSON document"):
        wide_entries(read_documents(spark, folder, PLAYLISTS), PLAYLISTS).collect()
    found = read_with_quarantine(spark, folder, PLAYLISTS)
    assert wide_entries(found.good, PLAYLISTS).count() == 7
    assert [(r.source_file.rsplit("/", 1)[-1], r.text) for r in found.rejects.collect()] == [(bad.name, text)]
    bad.write_text(headed)
    assert wide_entries(read_documents(spark, folder, PLAYLISTS), PLAYLISTS).count() == 8


def test_only_slice_files_are_read(spark, folder, tmp_path):
    expected = rows(wide_entries(read_documents(spark, folder, PLAYLISTS), PLAYLISTS))
    (tmp_path / "in" / "notes.txt").write_text("no document")
    (tmp_path / "in" / "other.json").write_text('{"playlists": [{"pid": 1, "tracks": []}]}')
    for paths in (folder, slice_paths(spark, folder, 9)):
        assert rows(wide_entries(read_documents(spark, paths, PLAYLISTS), PLAYLISTS)) == expected


def test_layouts_agree(spark, folder, tmp_path):
    docs = read_documents(spark, folder, PLAYLISTS)
    expected = rows(wide_entries(docs, PLAYLISTS))
    docs.select("playlists").write.json(str(tmp_path / "lines"))
    docs.select("playlists").write.parquet(str(tmp_path / "parquet"))
    for layout in ("lines", "parquet"):
        again = read_documents(spark, str(tmp_path / layout), PLAYLISTS, layout)
        assert rows(wide_entries(again, PLAYLISTS)) == expected
    texts = documents_from_text(spark.read.text(folder, wholetext=True), PLAYLISTS)
    assert rows(wide_entries(texts, PLAYLISTS)) == expected
    with pytest.raises(ValueError, match="layout"):
        read_documents(spark, folder, PLAYLISTS, "xml")


def test_continued_parents(spark):
    """A parent that goes on in a second document is one parent with all its entries."""
    from flatloom.sources.star_schema import ORDERS

    first = ("a", None, "false", 5, 0)
    docs = spark.createDataFrame(
        [
            ([(7, *first, [(0, 1, "s", 1, "n", 1, "r"), (1, 2, "t", 1, "n", 1, "r")])],),
            ([(7, None, None, None, None, 1, [(2, 3, "u", 1, "n", 1, "r")])],),
        ],
        ORDERS.schema,
    )
    parents = explode_parents(docs, ORDERS)
    assert rows(parent_rows(parents, ORDERS), "pid", "name") == [(7, "a")]
    assert rows(entries_per_parent(parents, ORDERS)) == [(7, 3)]
    assert rows(parents_without_entries(parents, ORDERS)) == []
    assert rows(wide_entries(docs, ORDERS), "pid", "pos") == [(7, 0), (7, 1), (7, 2)]
