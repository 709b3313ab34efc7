"""Counts and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from flatloom.operators.counts import (
    duplication,
    expected_counts as count_expected,
    hottest_keys as find_hottest_keys,
    parents_containing,
    table_counts as count_tables,
)
from flatloom.operators.hitters import heavy_hitters
from flatloom.operators.lookup import parents_of_keys, write_by_key
from flatloom.operators.medians import median_by
from flatloom.queries.nested import entries, entries_from_text
from flatloom.queries.registry import WIDE, query
from flatloom.scratch import new_path
from flatloom.sinks.tables import write_for_lookup
from flatloom.sources.star_schema import slice_of, table


@query("""
    select 'orders' tbl, count(*) n from orders
    union all select 'lineitem', count(*) from lineitem
    union all select 'supplier', count(*) from supplier""")
def table_counts(spark, sf_dir):
    return count_tables({name: table(spark, sf_dir, name) for name in ("orders", "lineitem", "supplier")})


@query(f"""
    select count(*) entries, count(distinct track_key) tracks, count(distinct album_key) albums,
        count(distinct artist_key) artists from {WIDE}""")
def expected_counts(spark, sf_dir):
    wide = entries_from_text(spark, sf_dir, "track_key", "album_key", "artist_key")
    return count_expected(wide, {"tracks": "track_key", "albums": "album_key", "artists": "artist_key"})


@query("select l_orderkey // 1000 slice_id, count(*) n from lineitem group by 1")
def slice_entry_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(slice_of("l_orderkey").alias("slice_id"))
    return lines.groupBy("slice_id").agg(F.count("*").alias("n"))


@query("select cast(sum(n) as bigint) total from (select count(*) n from lineitem group by l_orderkey // 1000)")
def total_of_slice_counts(spark, sf_dir):
    return slice_entry_counts(spark, sf_dir).agg(F.sum("n").alias("total"))


@query("select o_orderpriority, median(o_totalprice) med from orders group by 1")
def median_by_group(spark, sf_dir):
    return median_by(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", "med")


@query("""
    select count(*) entries, count(distinct l_suppkey) uniq,
        cast(count(*) as double) / count(distinct l_suppkey) ratio from lineitem""")
def dup_ratio(spark, sf_dir):
    return duplication(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query("select l_partkey, count(*) n from lineitem group by 1 order by n desc, l_partkey limit 10")
def hottest_keys(spark, sf_dir):
    return find_hottest_keys(table(spark, sf_dir, "lineitem"), "l_partkey", 10)


@query("select distinct l_orderkey pid from lineitem where l_partkey = 7")
def containing_playlists(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "pid")
    return parents_containing(facts, "l_partkey", 7, "pid")


@query("select distinct l_orderkey pid from lineitem where l_suppkey = 7")
def containing_playlists_by_layout(spark, sf_dir):
    """The same lookup on facts laid out by entry key, where the file statistics skip most of them."""
    facts = entries(spark, sf_dir, "pos", "track_key")
    path = new_path(spark, "facts-by-entry")
    write_for_lookup(facts, path, "track_key", "pid", "pos")
    stored = spark.read.schema(facts.schema).parquet(path)
    return parents_containing(stored, "track_key", 7, "pid")


@query("""
    select case when l_returnflag = 'N' then null else l_returnflag end flag, median(l_extendedprice) med
    from lineitem group by 1""")
def median_with_null_group(spark, sf_dir):
    """NULL is a group like any other."""
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    return median_by(table(spark, sf_dir, "lineitem").select(flag, "l_extendedprice"), "flag", "l_extendedprice", "med")


@query("select l_partkey, count(*) n from lineitem group by 1 order by n desc, l_partkey limit 25")
def heavy_hitters_flat(spark, sf_dir):
    """The most repeated parts by bounded counts of buckets; parts repeat about equally often."""
    return heavy_hitters(table(spark, sf_dir, "lineitem"), "l_partkey", 25)


@query("""
    select "key", flag, count(*) n from (
        select case when l_linenumber <= 2 then l_suppkey % 13 else 1000 + l_orderkey end "key", l_returnflag flag from lineitem)
    group by 1, 2 order by n desc, "key", flag limit 25""")
def heavy_hitters_skewed(spark, sf_dir):
    """A few keys of two columns hold a third of the rows; only their buckets are counted key by key."""
    key = F.when(F.col("l_linenumber") <= 2, F.col("l_suppkey") % 13).otherwise(1000 + F.col("l_orderkey"))
    rows = table(spark, sf_dir, "lineitem").select(key.alias("key"), F.col("l_returnflag").alias("flag"))
    return heavy_hitters(rows, ["key", "flag"], 25)


def _facts_by_part(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pid"), "l_partkey")
    path = new_path(spark, "facts-by-part")
    write_by_key(facts, path, "l_partkey", "pid")
    return path, facts.schema


@query("select distinct l_partkey, l_orderkey pid from lineitem join part on l_partkey = p_partkey where p_size = 7 and p_brand like '%1'")
def containing_any_of_few(spark, sf_dir):
    """The parents of a short list of keys, which the scan itself filters by."""
    path, schema = _facts_by_part(spark, sf_dir)
    keys = table(spark, sf_dir, "part").filter("p_size = 7 and p_brand like '%1'").select("p_partkey")
    return parents_of_keys(spark, path, schema, keys, "l_partkey", "pid")


@query("select distinct l_partkey, l_orderkey pid from lineitem join part on l_partkey = p_partkey where p_size <= 25")
def containing_any_of_many(spark, sf_dir):
    """The parents of a long list of keys, joined with folders pruned at run time."""
    path, schema = _facts_by_part(spark, sf_dir)
    keys = table(spark, sf_dir, "part").filter("p_size <= 25").select("p_partkey")
    return parents_of_keys(spark, path, schema, keys, "l_partkey", "pid")
