"""Fields that the model does not name."""

import json

import pytest
from documents import playlist, track

from flatloom.operators.undeclared import MALFORMED, undeclared_document_fields, undeclared_fields
from flatloom.schemas import PLAYLISTS


def found(df):
    return {(r.path, r.type): r.n for r in df.collect()}


def in_documents(spark, *docs):
    texts = [(d if isinstance(d, str) or d is None else json.dumps(d),) for d in docs]
    return found(undeclared_document_fields(spark.createDataFrame(texts, "text string"), "text", PLAYLISTS))


def test_clean_documents_have_none(spark):
    docs = {"playlists": [playlist(1, [track(0, "a")], description="x"), playlist(2), playlist(3, [])]}
    assert in_documents(spark, docs, {"playlists": []}, {}, None, {"playlists": None}) == {}


def test_fields_at_every_level(spark):
    entry = {**track(0, "a"), "isrc": "X1", "added": {"by": 1, "tags": ["a", "b"]}}
    docs = [
        {"playlists": [playlist(1, [entry, {**entry, "isrc": 7}]), {**playlist(2, [entry]), "mood": None}], "info": {"v": 1.5}},
        {"playlists": [{**playlist(3), "mood": "blue"}], "info": {"v": 2.5}},
    ]
    top, parents = "$.playlists[*]", "$.playlists[*].tracks[*]"
    assert in_documents(spark, *docs) == {
        ("$.info", "OBJECT<v: DECIMAL(2,1)>"): 2,
        (f"{top}.mood", "VOID"): 1,
        (f"{top}.mood", "STRING"): 1,
        (f"{parents}.isrc", "STRING"): 2,
        (f"{parents}.isrc", "BIGINT"): 1,
        (f"{parents}.added", "OBJECT<by: BIGINT, tags: ARRAY<STRING>>"): 3,
    }


def test_other_shapes_are_reported(spark):
    odd = {"playlists": [3, {**playlist(1), "tracks": {"0": track(0, "a")}}, {**playlist(2), "tracks": ["x", None]}, None]}
    got = in_documents(spark, odd, {"playlists": "none"}, "[1]", "{cut", "7")
    assert got.pop(("$.playlists[*].tracks", next(t for p, t in got if p == "$.playlists[*].tracks"))) == 1
    assert got == {
        ("$.playlists[*]", "BIGINT"): 1,
        ("$.playlists[*].tracks[*]", "STRING"): 1,
        ("$.playlists", "STRING"): 1,
        ("$", "ARRAY<BIGINT>"): 1,
        ("$", "BIGINT"): 1,
        ("$", MALFORMED): 1,
    }


@pytest.mark.parametrize("declared, expected", [((), {"$.a", "$.b"}), (("a",), {"$.b"}), (("a", "b"), set())])
def test_flat_objects(spark, declared, expected):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 2, "b": true}',), (None,)], "props string")
    assert {p for p, _ in found(undeclared_fields(df, "props", declared))} == expected
