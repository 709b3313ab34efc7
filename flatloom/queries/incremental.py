"""Chunks, partial results, the load log and document streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatloom.operators.checks import require_empty
from flatloom.operators.chunks import balanced_chunks
from flatloom.operators.counts import table_counts
from flatloom.operators.dedup import min_per_column
from flatloom.operators.flatten import wide_entries
from flatloom.operators.numbering import chunk_numbers
from flatloom.plans.incremental import Store, fact_count_mismatch, finalize, insert_ignore, load_batch, units_to_load
from flatloom.plans.normalize import load, normalize
from flatloom.plans.run import expected_table_counts, load_by_stream, timed_run
from flatloom.queries.nested import documents
from flatloom.queries.registry import WIDE, query
from flatloom.scratch import new_path, written
from flatloom.sinks.tables import append_by_name, read_tables, reset_tables
from flatloom.sources.documents import SOURCE, read_documents, stream_documents
from flatloom.sources.star_schema import ORDERS, slice_of, staged_documents, table
from flatloom.streaming.ingest import emit_new_keys, ingest

_TABLE_COUNTS = f"""
    with e as {WIDE}
    select 'artists' tbl, count(distinct artist_key) n from e
    union all select 'albums', count(distinct album_key) from e
    union all select 'tracks', count(distinct track_key) from e
    union all select 'playlists', count(*) from orders
    union all select 'playlist_tracks', count(*) from e"""


def files_per_batch(spark) -> int:
    """As many files as there are cores, so that none is idle: a few batches locally, large ones on a cluster."""
    return max(1, spark.sparkContext.defaultParallelism)


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_suppkey").alias("suppkey"), F.col("l_returnflag").alias("flag")
    )


@query("""
    select slice_id, cast((row_number() over (order by slice_id) - 1) // 4 as bigint) chunk_id
    from (select distinct l_orderkey // 1000 slice_id from lineitem)""")
def chunk_assignment(spark, sf_dir):
    slices = table(spark, sf_dir, "lineitem").select(slice_of("l_orderkey").alias("slice_id"))
    return chunk_numbers(slices, "slice_id", 4)


@query("""
    with recursive w as (
        select *, row_number() over (order by slice_id) i, sum(n) over (order by slice_id) p
        from (select l_orderkey // 1000 slice_id, count(*) n from lineitem group by 1)),
    b as (
        select distinct y.p - x.p + x.n bound from w x join w y on y.i >= x.i
        where y.p - x.p + x.n >= (select max(n) from w)),
    g(bound, i, chunk_id, filled) as (
        select bound, 1::bigint, 0::bigint, n::hugeint from b cross join w where i = 1
        union all
        select g.bound, w.i, case when g.filled + w.n > g.bound then g.chunk_id + 1 else g.chunk_id end,
            case when g.filled + w.n > g.bound then w.n else g.filled + w.n end
        from g join w on w.i = g.i + 1)
    select slice_id, n, chunk_id from g join w using (i)
    where bound = (select min(bound) from (select bound, max(chunk_id) most from g group by 1) where most < 4)""")
def chunks_of_equal_size(spark, sf_dir):
    """Four runs of slices whose largest has as few entries as can be."""
    slices = table(spark, sf_dir, "lineitem").groupBy(slice_of("l_orderkey").alias("slice_id")).agg(F.count("*").alias("n"))
    return balanced_chunks(slices, "slice_id", "n", 4)


@query("""
    select l_partkey, min(s) suppkey, min(f) flag from (
        select l_orderkey // 5000 chunk, l_partkey, min(l_suppkey) s, min(l_returnflag) f
        from lineitem group by 1, 2)
    group by 1""")
def two_level_equals_one_level(spark, sf_dir):
    """Minima per chunk are written, then collapsed over all chunks."""
    chunk = F.floor(F.col("l_orderkey") / 5000).cast("long").alias("chunk")
    chunks = _lines(spark, sf_dir).select(chunk, "l_partkey", "suppkey", "flag")
    partials = written(min_per_column(chunks, ["chunk", "l_partkey"], ["suppkey", "flag"], distinct_first=True), "partials")
    return min_per_column(partials, "l_partkey", ["suppkey", "flag"])


@query("""
    select l_partkey, min(l_suppkey) s from lineitem where l_orderkey < 5000 group by 1
    union all select l_partkey, min(l_suppkey) from lineitem where l_orderkey >= 5000 group by 1""")
def union_all_partials(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumnRenamed("suppkey", "s")
    parts = [lines.filter("l_orderkey < 5000"), lines.filter("l_orderkey >= 5000")]
    return reduce(DataFrame.unionByName, [min_per_column(p, "l_partkey", ["s"]) for p in parts])


@query("select distinct l_orderkey // 1000 slice_id from lineitem where l_orderkey // 1000 not in (0, 1, 2)")
def skip_loaded_slices(spark, sf_dir):
    """Of the slices that the line items come from, those that the load log does not name."""
    units = table(spark, sf_dir, "lineitem").select(slice_of("l_orderkey").alias("unit"))
    log = units.filter(F.col("unit") <= 2)
    return units_to_load(units, log).withColumnRenamed("unit", "slice_id")


@query(_TABLE_COUNTS)
def load_tables(spark, sf_dir):
    """Reset, load and count the five tables."""
    return table_counts(load(documents(spark, sf_dir), ORDERS, new_path(spark, "tables")))


@query(_TABLE_COUNTS)
def reload_changes_nothing(spark, sf_dir):
    """A batch delivered again under its own name, and its files again under another one."""
    store = Store(spark, new_path(spark, "store"), ORDERS)
    store.create()
    for batch in ("first-0", "first-0", "second-0"):
        load_batch(documents(spark, sf_dir), store, batch)
    return table_counts(store.tables())


@query("""
    select 'reported' source, count(*) n from lineitem
    union all select 'stored', count(*) from lineitem""")
def reported_entries(spark, sf_dir):
    """The entries that the batches reported, and those that the fact table holds."""
    store = Store(spark, new_path(spark, "store"), ORDERS)
    store.create()
    load_batch(documents(spark, sf_dir), store, "only-0")
    require_empty(fact_count_mismatch(store), "fact table")
    reported = store.log().agg(F.sum("n_entries").alias("n"))
    stored = store.read(ORDERS.fact_table).agg(F.count("*").alias("n"))
    named = [df.select(F.lit(name).alias("source"), "n") for name, df in (("reported", reported), ("stored", stored))]
    return named[0].unionByName(named[1])


@query("""
    select l_partkey, suppkey, flag from (
        select *, row_number() over (partition by l_partkey order by late, suppkey, flag) rn
        from (select l_partkey, l_suppkey suppkey, l_returnflag flag, l_orderkey >= 5000 late from lineitem))
    where rn = 1""")
def insert_ignore_parts(spark, sf_dir):
    """Parts of early orders are stored; later ones only add what is missing."""
    rows = _lines(spark, sf_dir)
    path = new_path(spark, "insert-ignore-target")
    empty = rows.drop("l_orderkey").limit(0)
    empty.write.parquet(path)
    for wave in ("l_orderkey < 5000", "l_orderkey >= 5000"):
        insert_ignore(path, rows.filter(wave).drop("l_orderkey"), "l_partkey")
    return spark.read.schema(empty.schema).parquet(path)


def _digest(tables) -> DataFrame:
    """(tbl, n, digest): the digest does not depend on the order of the rows."""
    parts = []
    for name, df in tables.items():
        row = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
        parts.append(
            df.agg(F.count("*").alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("digest")).select(
                F.lit(name).alias("tbl"), "n", "digest"
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query(f"select tbl, n, true same from ({_TABLE_COUNTS})")
def stream_equals_batch(spark, sf_dir):
    """All documents through a file stream, a few files per batch, against one batch job."""
    store = Store(spark, new_path(spark, "store"), ORDERS)
    store.create()
    docs = stream_documents(spark, staged_documents(spark, sf_dir), ORDERS, "lines", files_per_batch(spark))
    ingest(docs, store, new_path(spark, "stream-state"), "run").awaitTermination()
    streamed = _digest(store.tables())
    batch = _digest(normalize(documents(spark, sf_dir), ORDERS)).select("tbl", F.col("digest").alias("expected"))
    return streamed.join(batch, "tbl").select("tbl", "n", F.col("digest").eqNullSafe(F.col("expected")).alias("same"))


@query(f"""
    select album_key, name, artist_key from (
        select album_key, album_name name, artist_key,
            row_number() over (partition by album_key order by pid // 1000, pid desc, pos desc) rn
        from {WIDE})
    where rn = 1""")
def stream_first_slice_wins(spark, sf_dir):
    """A stream that keeps winners with their places, collapsed over its batches."""
    store = Store(spark, new_path(spark, "store"), ORDERS, "first_slice")
    store.create()
    docs = stream_documents(spark, staged_documents(spark, sf_dir), ORDERS, "lines", files_per_batch(spark))
    # Every document is a slice of its own, named by the first key in it.
    start = F.floor(F.col(ORDERS.parents)[0]["pid"] / 1000).cast("string")
    named = docs.withColumn(SOURCE, F.concat(F.lit("slice."), start, F.lit("-"), start, F.lit("-"), F.xxhash64(ORDERS.parents)))
    ingest(named, store, new_path(spark, "stream-state"), "run").awaitTermination()
    return finalize(store)["albums"].select("album_key", "name", "artist_key")


@query("""
    select o_orderkey // 1000 sl, count(*) playlists from orders group by 1""")
def same_name_files_both_load(spark, sf_dir):
    """All documents arrive under one file name in different folders, and once more in others: none is lost."""
    store = Store(spark, new_path(spark, "store"), ORDERS)
    store.create()
    docs = documents(spark, sf_dir)
    again = [docs.withColumn(SOURCE, F.concat(F.lit(f"{top}/"), F.xxhash64(ORDERS.parents), F.lit("/slice.0-999.json"))) for top in "ab"]
    for number, batch in enumerate(again):
        load_batch(batch, store, f"run-{number}")
    stored = finalize(store)[ORDERS.parent_table]
    return stored.groupBy(slice_of("pid").alias("sl")).agg(F.count("*").alias("playlists"))


@query("select pid, pos, track_key from (select * from " + WIDE + ")")
def append_by_name_roundtrip(spark, sf_dir):
    """Tables are reset, then filled by two appends whose columns come in another order."""
    root = new_path(spark, "appended")
    reset_tables(spark, root, ORDERS)
    schema = ORDERS.table_schema(ORDERS.fact_table)
    facts = normalize(documents(spark, sf_dir), ORDERS)[ORDERS.fact_table].select("track_key", "pos", "pid")
    for part in ("pid % 2 = 0", "pid % 2 != 0"):
        append_by_name(facts.filter(part), f"{root}/{ORDERS.fact_table}", schema)
    return read_tables(spark, root, ORDERS)[ORDERS.fact_table]


@query("""
    select * from (values ('good', 'OK'), ('cut', 'LOAD_FAILED'), ('orphans', 'CONSTRAINTS_FAILED'),
        ('unreadable', 'CONSTRAINTS_FAILED'), ('lossy', 'MISMATCH')) r(loader, status)""")
def run_outcomes(spark, sf_dir):
    """Five real runs: a good one, one that meets cut documents, and three whose tables are damaged after the load."""
    expected = written(expected_table_counts(lambda p=None, e=(): documents(spark, sf_dir, p, e), ORDERS), "expected")

    def tables():
        return load(documents(spark, sf_dir), ORDERS, new_path(spark, "tables"))

    def cut():
        path = new_path(spark, "cut")
        text = spark.read.text(staged_documents(spark, sf_dir))
        text.select(F.expr("substring(value, 1, length(value) div 2)").alias("value")).write.text(path)
        return load(read_documents(spark, path, ORDERS, "lines"), ORDERS, new_path(spark, "tables"))

    def orphans():
        found = tables()
        return found | {"tracks": found["tracks"].filter("track_key % 2 = 0")}

    def unreadable():
        found = tables()
        broken = F.raise_error(F.lit("damaged")).cast("string")
        return found | {"artists": found["artists"].withColumn("name", F.when(F.col("artist_key") >= 0, broken))}

    def lossy():
        found = tables()
        return found | {ORDERS.fact_table: found[ORDERS.fact_table].filter("pos > 0")}

    ways = {"good": tables, "cut": cut, "orphans": orphans, "unreadable": unreadable, "lossy": lossy}
    records = [timed_run(spark, name, ORDERS, expected, way) for name, way in ways.items()]
    return reduce(DataFrame.unionByName, records).select("loader", "status")


@query(f"select distinct track_key, track_name from {WIDE}")
def stream_new_keys(spark, sf_dir):
    """Each track when it is first seen in the stream."""
    docs = stream_documents(spark, staged_documents(spark, sf_dir), ORDERS, "lines", files_per_batch(spark))
    rows = wide_entries(docs, ORDERS).select("track_key", "track_name")
    out = new_path(spark, "new-keys")
    emit_new_keys(rows, "track_key", out, new_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out).select(*rows.columns)


@query(f"""
    with n as ({_TABLE_COUNTS})
    select loader, 'OK' status, 1 rep,
        max(n) filter (tbl = 'artists') artists, max(n) filter (tbl = 'albums') albums,
        max(n) filter (tbl = 'tracks') tracks, max(n) filter (tbl = 'playlists') playlists,
        max(n) filter (tbl = 'playlist_tracks') playlist_tracks
    from n cross join (values ('batch'), ('stream')) w(loader) group by loader""")
def run_records(spark, sf_dir):
    """Two whole runs, by batch and by stream: load, constraints, counts, record."""

    def docs(parent_fields=None, entry_fields=()):
        return documents(spark, sf_dir, parent_fields, entry_fields)

    def by_batch():
        return load(docs(), ORDERS, new_path(spark, "tables"))

    def by_stream():
        files = stream_documents(spark, staged_documents(spark, sf_dir), ORDERS, "lines", files_per_batch(spark))
        return load_by_stream(files, ORDERS, new_path(spark, "tables"), "run", new_path(spark, "stream-state"))

    expected = written(expected_table_counts(docs, ORDERS), "expected")
    runs = [
        timed_run(spark, name, ORDERS, expected, way) for name, way in (("batch", by_batch), ("stream", by_stream))
    ]
    counts = ["artists", "albums", "tracks", "playlists", "playlist_tracks"]
    return runs[0].unionByName(runs[1]).select("loader", "status", "rep", *counts)
