"""Where intermediate tables go, and that they do not pile up."""

from pathlib import Path
from types import SimpleNamespace

import pytest
from documents import rows, three_slices

from flatloom import scratch
from pyspark.sql import functions as F

from flatloom.operators.medians import median_by
from flatloom.operators.numbering import positions_within
from flatloom.plans.incremental import Store, finalize, load_batch
from flatloom.plans.normalize import load
from flatloom.plans.run import run_folder
from flatloom.schemas import PLAYLISTS
from flatloom.sources.documents import read_documents, read_with_quarantine, stream_documents
from flatloom.streaming.ingest import ingest


def session(master, folder=None):
    """As much of a session as the choice of the folder looks at."""
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_the_folder_named_by_the_session_is_used():
    assert scratch.scratch_root(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_has_to_name_a_folder():
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
            scratch.scratch_root(session(master))


def test_local_sessions_get_one_temporary_folder():
    first = scratch.scratch_root(session("local[2]"))
    assert first == scratch.scratch_root(session("local[2]"))


def test_written_tables_are_independent(spark):
    a, b = (scratch.written(spark.range(3), "t") for _ in range(2))
    assert rows(a) == rows(b) == [(0,), (1,), (2,)]
    assert a.inputFiles() != b.inputFiles()


def test_nothing_is_left_in_scratch(spark, tmp_path):
    """Loads, streams and quarantine, numbering and medians inside a block, all remove what they wrote."""

    def left():
        return set(Path(scratch.scratch_root(spark)).iterdir())

    before = left()
    folder = str(three_slices(tmp_path / "in"))
    docs = read_documents(spark, folder, PLAYLISTS)
    load(docs, PLAYLISTS, str(tmp_path / "out"), "first_slice")
    store = Store(spark, str(tmp_path / "store"), PLAYLISTS)
    store.create()
    ingest(stream_documents(spark, folder, PLAYLISTS), store, str(tmp_path / "state"), "run").awaitTermination()
    finalize(store)
    run_folder(spark, folder, str(tmp_path / "by-stream"), PLAYLISTS, "stream")
    with scratch.stages(spark):
        numbers = spark.range(50).withColumn("key", F.col("id") % 3)
        assert positions_within(numbers, "key", ["id"]).count() == 50
        assert median_by(numbers, "key", "id").count() == 3
        assert read_with_quarantine(spark, folder, PLAYLISTS).good.count() == 3
        assert left() != before
    assert left() == before


def test_a_failed_load_leaves_nothing_either(spark, tmp_path):
    before = set(Path(scratch.scratch_root(spark)).iterdir())
    folder = three_slices(tmp_path / "in")
    (folder / "slice.1-2.json").write_text("{")
    with pytest.raises(Exception, match="not exactly one"):
        load(read_documents(spark, str(folder), PLAYLISTS), PLAYLISTS, str(tmp_path / "out"))
    assert set(Path(scratch.scratch_root(spark)).iterdir()) == before


def test_creating_a_store_again_empties_it(spark, tmp_path):
    docs = read_documents(spark, str(three_slices(tmp_path / "in")), PLAYLISTS)
    store = Store(spark, str(tmp_path / "store"), PLAYLISTS)
    for _ in range(2):
        store.create()
        assert store.log().isEmpty()
        load_batch(docs, store, "b0")
        assert store.tables()["playlist_tracks"].count() == 7
