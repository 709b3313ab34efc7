"""Run reports, and writers that need no cluster to be checked."""

from unittest.mock import MagicMock

import pytest
from documents import rows
from pyspark.sql import functions as F

from flatloom.operators.reports import throughput, with_label
from flatloom.schemas import PLAYLISTS, RUN_RESULT
from flatloom.sinks.tables import append_over_jdbc, append_run_results, publish_over_jdbc, read_run_results


def run(at, loader, load, constraints, rep, status="OK", slices=100):
    total = round(load + constraints, 1)
    return (at, loader, slices, load, constraints, total, 0, status, 1, 1, 1, 1, 6_677_800, rep)


RUNS = [
    run("2026-01-01T00:00:01+00:00", "b", 99.0, 99.0, 1),
    run("2026-01-01T00:00:02+00:00", "a", 13.7, 31.1, 1),
    run("2026-01-01T00:00:03+00:00", "b", 24.0, 28.0, 2),
    run("2026-01-01T00:00:04+00:00", "b", 22.0, 29.0, 3),
    run("2026-01-01T00:00:05+00:00", "b", 22.5, 20.0, 4),
    run("2026-01-01T00:00:06+00:00", "a", 14.1, 30.0, 2),
    run("2026-01-01T00:00:07+00:00", "a", 1.0, 0.0, 3, status="MISMATCH"),
    run("2026-01-01T00:00:08+00:00", "a", 1.0, 1.0, 3, slices=10),
]


@pytest.fixture
def results(spark, tmp_path):
    path = str(tmp_path / "results")
    frame = spark.createDataFrame(RUNS, RUN_RESULT)
    # Whatever order a frame has its columns in, the file has the declared one.
    append_run_results(frame.filter("rep = 1").select(*reversed(frame.columns)), path)
    append_run_results(frame.filter("rep > 1"), path)
    return path


def test_results_file_keeps_its_column_order(spark, results):
    found = read_run_results(spark, results)
    assert rows(found) == sorted(RUNS)
    assert found.schema == RUN_RESULT


def test_a_results_file_with_shifted_columns_is_refused(spark, results):
    shifted = spark.createDataFrame(RUNS, RUN_RESULT).select(*reversed(RUN_RESULT.fieldNames()))
    shifted.write.mode("append").option("header", "true").csv(results)
    with pytest.raises(Exception, match="(?i)header"):
        read_run_results(spark, results).collect()


def test_report_of_latest_runs(spark, results):
    runs = read_run_results(spark, results).filter("slices = 100 and status = 'OK'")
    newest = [F.desc("run_at"), F.desc("rep")]
    report = throughput(runs, "loader", newest, "load_s", "constraints_s", F.col("playlist_tracks"))
    a, b = report.collect()
    # Two runs: the mean of both. Three of four runs: the oldest is left out.
    assert (a.loader, round(a.med_load, 6), round(a.med_constraints, 6), a.runs) == ("a", 13.9, 30.55, 2)
    assert (b.loader, b.med_load, b.med_constraints, b.runs) == ("b", 22.5, 28.0, 3)
    # The sum of two medians, not the median of the sums.
    assert b.total == 50.5
    assert b.rate == 6_677_800 / 22.5


def test_labels(spark):
    codes = spark.createDataFrame([("x",), ("y",)], "code string")
    labels = spark.createDataFrame([("x", "Ex"), ("x", "Xe")], "code string, label string")
    assert rows(with_label(codes, labels, "code"), "code", "label") == [("x", "Ex"), ("y", "y")]
    assert rows(with_label(codes, labels, "code", keep_unknown=False), "code", "label") == [("x", "Ex")]


def test_jdbc_writer_passes_batching_on():
    frame = MagicMock()
    append_over_jdbc(frame, "jdbc:some:url", "artists", {"user": "u", "batchsize": "5"})
    frame.write.mode.assert_called_once_with("append")
    frame.write.mode.return_value.jdbc.assert_called_once_with(
        "jdbc:some:url",
        "artists",
        properties={"batchsize": "5", "reWriteBatchedInserts": "true", "user": "u"},
    )


def test_tables_are_published_before_what_refers_to_them():
    order = []
    frames = {}
    for table in PLAYLISTS.tables:
        frames[table] = MagicMock()
        frames[table].write.mode.return_value.jdbc.side_effect = lambda url, name, properties: order.append(name)
    publish_over_jdbc(frames, "jdbc:some:url", {})
    assert order == ["artists", "albums", "tracks", "playlists", "playlist_tracks"]
    assert all(order.index(r.parent) < order.index(r.table) for r in PLAYLISTS.references)
