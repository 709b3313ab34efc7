"""Numbering and medians with a hot key, many copies and NULL keys."""

import statistics

import pytest
from documents import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flatloom.operators.medians import median_by
from flatloom.operators.numbering import chunk_numbers, positions, positions_within


@pytest.fixture(scope="module")
def hot_rows(spark):
    """A third of the rows under one key, half of these being copies of one row."""
    hot = [(7, v % 200 if v % 2 else 5) for v in range(2000)]
    data = hot + [(k, k % 13) for k in range(1000, 2000) for _ in range(4)]
    return spark.createDataFrame(data, "key int, v int").repartition(6)


def expected_positions(df):
    groups: dict = {}
    for key, v in sorted((r.key, r.v) for r in df.collect()):
        groups.setdefault(key, []).append(v)
    return {(k, i): v for k, vs in groups.items() for i, v in enumerate(vs)}


def test_positions_within(spark, hot_rows):
    found = positions_within(hot_rows, "key", ["v"], "pos").collect()
    assert {(r.key, r.pos): r.v for r in found} == expected_positions(hot_rows)
    assert found[0].__fields__ == ["key", "v", "pos"]
    assert len(found) == 6000


def test_positions_within_the_null_key(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), (1, 2), (None, None)], "key int, v int")
    assert rows(positions_within(df, "key", ["v"])) == [(1, 2, 0), (None, 1, 1), (None, 3, 2), (None, None, 0)]


def test_positions_of_all_rows(spark, hot_rows):
    found = sorted((r.at, r.key, r.v) for r in positions(hot_rows, ["key", "v"], "at").collect())
    assert [f[0] for f in found] == list(range(6000))
    assert [f[1:] for f in found] == sorted((r.key, r.v) for r in hot_rows.collect())


def test_chunk_numbers(spark):
    slices = spark.createDataFrame([(s * 1000,) for s in range(25) for _ in range(3)], "slice long")
    found = rows(chunk_numbers(slices, "slice", 10))
    assert sorted(found) == [(s * 1000, s // 10) for s in range(25)]


VALUES = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 50))), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None)
@given(VALUES)
def test_medians_against_brute_force(spark, values):
    df = spark.createDataFrame([(g, None if v is None else v / 4) for g, v in values], "g string, v double")
    groups: dict = {}
    for g, v in values:
        if v is not None:
            groups.setdefault(g, []).append(v / 4)
    expected = [(g, statistics.median(vs)) for g, vs in groups.items()]
    assert rows(median_by(df, "g", "v")) == sorted(expected, key=lambda r: (r[0] is None, str(r)))


def test_median_of_hot_group(spark, hot_rows):
    built_in = hot_rows.groupBy("key").agg(F.median("v").alias("median"))
    assert rows(median_by(hot_rows, "key", "v")) == rows(built_in)


def test_median_of_intervals(spark):
    df = spark.sql("select g, make_dt_interval(0, 0, 0, v) v from values ('a', 1), ('a', 2), ('a', 9), ('b', 4), ('b', 7) t(g, v)")
    built_in = df.groupBy("g").agg(F.median("v").alias("median"))
    assert rows(median_by(df, "g", "v")) == rows(built_in)


def test_medians_whatever_the_sketch_says(spark, hot_rows, monkeypatch):
    """Brackets that miss the middle, and groups that are cut until they fit, give the same medians."""
    from flatloom.operators import medians

    data = [(k, float("nan") if k == 5 and i % 4 else float((i * 7919) % 1009)) for k in range(4, 8) for i in range(900 + k)]
    df = spark.createDataFrame([*data, *((9, float(i % 2)) for i in range(40)), (None, 1.0)], "key int, v double")
    built_in = rows(df.groupBy("key").agg(F.median("v").alias("median")).select("key", "median").withColumn("median", F.col("median").cast("string")))
    monkeypatch.setattr(medians, "RANKED", 3)
    monkeypatch.setattr(medians, "SPLITS", 4)
    for bracket in (0.01, 0.4, 0.0):
        monkeypatch.setattr(medians, "BRACKET", bracket)
        assert rows(median_by(df, "key", "v").withColumn("median", F.col("median").cast("string"))) == built_in
    # A sketch that is far off: the bracket lies at the top.
    monkeypatch.setattr(medians, "_brackets", lambda valued: valued.groupBy(F.col("_group").alias("_g")).agg(
        F.count("*").alias("_total"), F.max("_number").alias("_from"), F.max("_number").alias("_to")))
    assert rows(median_by(df, "key", "v").withColumn("median", F.col("median").cast("string"))) == built_in


def test_values_are_not_gathered_by_group_to_meet_their_brackets(spark):
    """A group with a third of the values would be sorted by one task."""
    from flatloom.operators import medians

    valued = spark.range(3000).selectExpr("id % 3 _group", "cast(id as double) _value", "cast(id as double) _number")
    brackets, largest = medians._small(medians._brackets(valued))
    plan = medians._sides(valued, brackets)._jdf.queryExecution().toString()
    assert largest == 1000 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_positions_by_slice(spark, hot_rows, monkeypatch):
    """Slices that a task can sort and one that is too large, with NULL keys, give the numbers of one way."""
    from flatloom.operators import numbering

    nulls = spark.createDataFrame([(None, v % 30) for v in range(300)], "key int, v int")
    df = hot_rows.unionByName(nulls)
    expected = rows(numbering.positions_within(df, "key", ["v"]))
    for most in (1 << 20, 250, 5):
        monkeypatch.setattr(numbering, "TASK_ROWS", most)
        assert rows(numbering.positions_by_slice(df, "key", F.floor(F.col("key") / 100), ["v"])) == expected
