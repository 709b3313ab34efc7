"""Nested documents from tables in which one order holds a third of the line items."""

import shutil

import pytest
from documents import rows
from pyspark.sql import functions as F

from flatloom.operators.flatten import (
    entries_per_parent,
    explode_parents,
    parent_rows,
    parents_without_entries,
    wide_entries,
)
from flatloom.plans.normalize import load
from flatloom.sources.documents import read_documents
from flatloom.sources.star_schema import LINE_ORDER, ORDERS, PART_ENTRIES, nested_documents, staged_documents

N_HOT = 3 * PART_ENTRIES + 17


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Order 5 has many line items, most of them copies of one; order 9 has none."""
    root = str(tmp_path_factory.mktemp("tables"))
    small = {
        "region": (2, "id as r_regionkey, concat('r', id) as r_name"),
        "nation": (4, "id as n_nationkey, concat('n', id) as n_name, id % 2 as n_regionkey"),
        "supplier": (10, "cast(id as long) as s_suppkey, concat('s', id) as s_name, id % 4 as s_nationkey"),
    }
    for name, (n, columns) in small.items():
        spark.range(n).selectExpr("cast(id as int) id").createOrReplaceTempView("ids")
        spark.sql(f"select {columns} from ids").write.parquet(f"{root}/{name}.parquet")
    spark.range(10).selectExpr(
        "id as o_orderkey",
        "case when id % 3 = 0 then 'P' else 'F' end as o_orderstatus",
        "'high' as o_orderpriority",
        "timestamp_ntz'2020-01-01 00:00:10' as o_orderdate",
    ).write.parquet(f"{root}/orders.parquet")
    copies = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("v")
    hot = spark.range(N_HOT).select(F.lit(5).cast("long").alias("l_orderkey"), copies)
    cold = spark.range(2 * N_HOT).select((F.col("id") % 9).alias("l_orderkey"), F.col("id").alias("v"))
    lines = hot.unionByName(cold.filter("l_orderkey <> 5"))
    lines.select(
        "l_orderkey",
        (F.col("v") % 7).cast("int").alias("l_linenumber"),
        F.col("v").alias("l_partkey"),
        (F.col("v") % 10).alias("l_suppkey"),
        *[F.lit(0.0).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        *[F.lit("A").alias(c) for c in ("l_returnflag", "l_linestatus")],
        F.expr("timestamp_ntz'2020-01-01 00:00:00'").alias("l_shipdate"),
    ).write.parquet(f"{root}/lineitem.parquet")
    return root


def expected(spark, root):
    """(pid, pos, supplier) by sorting in Python."""
    groups: dict = {}
    columns = ["l_orderkey", *LINE_ORDER]
    for row in sorted(tuple(r) for r in spark.read.parquet(f"{root}/lineitem.parquet").select(*columns).collect()):
        groups.setdefault(row[0], []).append(row[3])
    return sorted((k, i, s) for k, v in groups.items() for i, s in enumerate(v))


def test_a_replaced_table_is_staged_again(spark, tables, tmp_path):
    """What is kept for an input is found by the input's files, not by its path alone."""
    copy = str(tmp_path / "copy")
    shutil.copytree(tables, copy)
    before = staged_documents(spark, copy)
    assert staged_documents(spark, copy) == before
    spark.read.parquet(f"{tables}/orders.parquet").filter("o_orderkey < 3").write.mode("overwrite").parquet(f"{copy}/orders.parquet")
    after = staged_documents(spark, copy)
    docs = read_documents(spark, after, ORDERS, "lines", ["pid", "name"], None)
    found = explode_parents(docs, ORDERS).filter("name is not null")
    assert after != before and found.count() == 3


def test_a_hot_order_is_split_over_documents(spark, tables):
    docs = nested_documents(spark, tables)
    wide = wide_entries(docs, ORDERS)
    assert sorted(tuple(r) for r in wide.select("pid", "pos", "track_key").collect()) == expected(spark, tables)
    largest = docs.select(F.explode("playlists").alias("p")).agg(F.max(F.size("p.tracks"))).first()[0]
    assert largest == PART_ENTRIES
    assert docs.filter("part > 0").count() == 3


def test_a_split_order_is_one_parent(spark, tables, tmp_path):
    docs = nested_documents(spark, tables)
    parents = explode_parents(docs, ORDERS)
    assert rows(parent_rows(parents, ORDERS), "pid") == [(k,) for k in range(10)]
    assert rows(parents_without_entries(parents, ORDERS)) == [(9,)]
    assert dict(tuple(r) for r in entries_per_parent(parents, ORDERS).collect())[5] == N_HOT
    stored = load(docs, ORDERS, str(tmp_path / "out"))
    assert {t: df.count() for t, df in stored.items()} == {
        "artists": 2, "albums": 4, "tracks": 10, "playlists": 10, "playlist_tracks": len(expected(spark, tables)),
    }
    assert rows(stored["playlists"].filter("pid in (0, 5)"), "pid", "description", "collaborative") == [
        (0, None, False),
        (5, "high", True),
    ]


def test_staged_documents_are_compressed_and_whole(spark, tables):
    """The text repeats names in every entry; staged, it takes a fraction of that, with the same entries."""
    path = staged_documents(spark, tables)
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    assert all(f.path.endswith(".json.gz") for f in files)
    wide = wide_entries(read_documents(spark, path, ORDERS, "lines"), ORDERS)
    assert sorted(tuple(r) for r in wide.select("pid", "pos", "track_key").collect()) == expected(spark, tables)


def test_line_items_are_shuffled_once_to_be_numbered(spark, tables):
    """Nothing but sizes of slices is written on the way, and slices beyond a task go over ranges."""
    from flatloom.sources import star_schema

    plan = nested_documents(spark, tables)._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning(l_orderkey" in plan and "range-offsets" not in plan and "spread" not in plan
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("flatloom.operators.numbering.TASK_ROWS", 50)
        wide = wide_entries(star_schema.nested_documents(spark, tables), ORDERS)
        assert sorted(tuple(r) for r in wide.select("pid", "pos", "track_key").collect()) == expected(spark, tables)
