"""The winner rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from flatloom.operators.dedup import (
    any_row,
    dimension_table,
    first_row,
    first_slice_wins,
    last_write_wins,
    min_per_column,
    new_keys,
    smallest_row,
)
from flatloom.operators.flatten import ENTRY_ORD, PARENT_ORD, entry_rows, explode_parents
from flatloom.queries.nested import documents, entries
from flatloom.queries.registry import LAST_IN_SLICE, WIDE, query
from flatloom.sources.star_schema import LINE_ORDER, ORDERS, slice_of, table

ARTISTS, ALBUMS, TRACKS = ORDERS.dimensions
# Within a part, line items follow one another by order, then by the remaining columns.
PART_ORDER = ["l_orderkey", *[c for c in LINE_ORDER if c != "l_partkey"]]


def _dimension(spark, sf_dir, dim, rule="min"):
    wide = entries(spark, sf_dir, dim.key, *dim.attributes.values())
    return dimension_table(wide, dim, rule)


def _sliced_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("sl", slice_of("l_orderkey"))


@query(f"select artist_key, min(artist_name) name from {WIDE} group by 1")
def dedup_min_region(spark, sf_dir):
    return _dimension(spark, sf_dir, ARTISTS)


@query(f"select album_key, min(album_name) name, min(artist_key) artist_key from {WIDE} group by 1")
def dedup_min_nation(spark, sf_dir):
    return _dimension(spark, sf_dir, ALBUMS)


@query(f"select track_key, min(track_name) name, min(album_key) album_key from {WIDE} group by 1")
def dedup_min_supplier(spark, sf_dir):
    return _dimension(spark, sf_dir, TRACKS)


@query("select l_partkey, min(l_suppkey) suppkey, min(l_returnflag) flag from lineitem group by 1")
def dedup_min_part_violating(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_suppkey").alias("suppkey"), F.col("l_returnflag").alias("flag")
    )
    return min_per_column(lines, "l_partkey", ["suppkey", "flag"])


@query("""
    select l_partkey, l_suppkey, l_returnflag from (
        select distinct l_partkey, l_suppkey, l_returnflag,
            rank() over (partition by l_partkey order by l_suppkey, l_returnflag) r from lineitem)
    where r = 1""")
def dedup_smallest_row_part(spark, sf_dir):
    """A whole row per part: never a combination that no row had."""
    return smallest_row(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_suppkey", "l_returnflag"])


@query(f"select sl, l_partkey, l_suppkey, l_returnflag from {LAST_IN_SLICE} where rn = 1")
def dedup_last_wins_in_slice(spark, sf_dir):
    lines = _sliced_lines(spark, sf_dir)
    return last_write_wins(lines, ["sl", "l_partkey"], ["l_suppkey", "l_returnflag"], PART_ORDER)


@query(f"""
    select l_partkey, l_suppkey, l_returnflag from (
        select *, row_number() over (partition by l_partkey order by sl) r2
        from {LAST_IN_SLICE} where rn = 1)
    where r2 = 1""")
def dedup_first_slice_wins(spark, sf_dir):
    lines = _sliced_lines(spark, sf_dir)
    return first_slice_wins(lines, "l_partkey", ["l_suppkey", "l_returnflag"], "sl", PART_ORDER)


@query(f"""
    select album_key, track_key, track_name from (
        select *, row_number() over (partition by album_key order by pid // 1000, pid desc, pos desc) rn
        from {WIDE})
    where rn = 1""")
def dedup_first_slice_wins_documents(spark, sf_dir):
    """The same rule over document places, which are numbers: one aggregate finds the winner."""
    wide = entries(spark, sf_dir, "pos", "album_key", "track_key", "track_name").withColumn("sl", slice_of("pid"))
    return first_slice_wins(wide, "album_key", ["track_key", "track_name"], "sl", ["pid", "pos"])


@query("""
    select distinct on (l_partkey) l_partkey, l_suppkey, l_returnflag from lineitem
    order by l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate""")
def distinct_on_first_row(spark, sf_dir):
    return first_row(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_suppkey", "l_returnflag"], PART_ORDER)


@query("""
    select distinct l_partkey from lineitem a
    where l_orderkey // 1000 >= 1 and not exists (
        select 1 from lineitem b where b.l_orderkey // 1000 < 1 and b.l_partkey = a.l_partkey)""")
def new_keys_only(spark, sf_dir):
    """Parts that the first slice did not bring and a later one does."""
    lines = _sliced_lines(spark, sf_dir).select("sl", "l_partkey")
    return new_keys(lines.filter("sl >= 1"), lines.filter("sl < 1"), "l_partkey")


@query(f"select distinct track_key, track_name, album_key from {WIDE}")
def dedup_any_supplier(spark, sf_dir):
    wide = entries(spark, sf_dir, "track_key", "track_name", "album_key")
    return any_row(wide, "track_key", ["track_name", "album_key"], deterministic=False)


@query(f"""
    select album_key, track_key, track_name from (
        select *, row_number() over (partition by album_key order by pid desc, pos desc) rn from {WIDE})
    where rn = 1""")
def last_write_by_ordinals(spark, sf_dir):
    """All entries by their real places in the documents' arrays: the last one stands."""
    docs = documents(spark, sf_dir, ["pid", "part"], ["pos", "album_key", "track_key", "track_name"])
    wide = entry_rows(explode_parents(docs, ORDERS, ordinals=True).withColumnRenamed("part", "_part"), ORDERS, True)
    # The places in the arrays follow one another within a document; a long order goes on in another.
    return last_write_wins(wide, "album_key", ["track_key", "track_name"], ["pid", "pos", PARENT_ORD, ENTRY_ORD])


@query(f"""
    select sl, album_key, track_key, track_name from (
        select *, pid // 1000 sl,
            row_number() over (partition by pid // 1000, album_key order by pid desc, pos desc) rn from {WIDE})
    where rn = 1""")
def last_write_by_ordinals_in_slices(spark, sf_dir):
    """Every slice's entries by their real places in the documents' arrays: the last of each slice stands."""
    docs = documents(spark, sf_dir, ["pid", "part"], ["pos", "album_key", "track_key", "track_name"])
    wide = entry_rows(explode_parents(docs, ORDERS, ordinals=True).withColumnRenamed("part", "_part"), ORDERS, True)
    wide = wide.withColumn("sl", slice_of("pid"))
    return last_write_wins(wide, ["sl", "album_key"], ["track_key", "track_name"], ["pid", "pos", PARENT_ORD, ENTRY_ORD])
