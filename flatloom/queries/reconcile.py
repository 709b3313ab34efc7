"""Differences by value between two copies of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatloom.plans.normalize import normalize
from flatloom.plans.reconcile import rows_that_differ, slices_that_differ, write_sliced
from flatloom.queries.nested import documents
from flatloom.queries.registry import WIDE, query
from flatloom.scratch import new_path
from flatloom.sources.star_schema import ORDERS

# A track changed, an entry lost, an entry added, and a name and a flag changed; all counts but two stay.
_CHANGED, _LOST, _ADDED = "pid % 1999 = 7", "pid % 2503 = 11 and pos = 0", "pid % 2999 = 13"
_RENAMED, _FLAGGED = "artist_key = 2", "pid % 4001 = 19"


def _two_copies(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The tables as they are, and with planted faults."""
    tables = normalize(documents(spark, sf_dir), ORDERS)
    facts, parents, artists = (tables[t] for t in ("playlist_tracks", "playlists", "artists"))
    wrong = facts.filter(f"not ({_LOST})").withColumn("track_key", F.col("track_key") + F.when(F.expr(_CHANGED), 1).otherwise(0))
    added = parents.filter(_ADDED).select("pid", F.lit(1_000_000).alias("pos"), F.lit(5).cast("long").alias("track_key"))
    damaged = tables | {
        "playlist_tracks": wrong.unionByName(added),
        "playlists": parents.withColumn("collaborative", F.col("collaborative") != F.expr(_FLAGGED)),
        "artists": artists.withColumn("name", F.when(F.expr(_RENAMED), F.lower("name")).otherwise(F.col("name"))),
    }
    roots = new_path(spark, "as-expected"), new_path(spark, "as-loaded")
    for root, found in zip(roots, (tables, damaged), strict=True):
        write_sliced(found, root, ORDERS)
    return roots


_ADDED_ROWS = f"(select o_orderkey pid from orders where {_ADDED.replace('pid', 'o_orderkey')})"


@query(f"""
    with e as {WIDE},
    touched as (
        select pid // 1000 slice from e where {_CHANGED} or ({_LOST})
        union select pid // 1000 from {_ADDED_ROWS}),
    n as (select pid // 1000 slice, count(*) n_left, count(*) filter ({_LOST}) lost from e group by 1),
    more as (select pid // 1000 slice, count(*) added from {_ADDED_ROWS} group by 1),
    p as (select o_orderkey // 1000 slice, count(*) n, count(*) filter ({_FLAGGED.replace("pid", "o_orderkey")}) flagged
        from orders group by 1)
    select 'playlist_tracks' tbl, slice, n_left, n_left - lost + coalesce(added, 0) n_right
    from touched join n using (slice) left join more using (slice)
    union all select 'playlists', slice, n, n from p where flagged > 0""")
def differing_slices(spark, sf_dir):
    """The slices of parents and facts whose values differ, found from digests alone."""
    found = slices_that_differ(spark, *_two_copies(spark, sf_dir), ORDERS)
    # The slices of dimensions are buckets of a hash that SQL does not have.
    return found.filter(F.col("tbl").isin("playlists", "playlist_tracks"))


@query(f"""
    with e as {WIDE}
    select 'playlist_tracks' tbl, '{{"pid":' || pid || ',"pos":' || pos || '}}' "key",
        case when {_LOST} then 'missing' else 'changed' end kind, 1::bigint n_left,
        case when {_LOST} then 0 else 1 end::bigint n_right, case when not ({_LOST}) then 'track_key' end "columns"
    from e where {_CHANGED} or ({_LOST})
    union all select 'playlist_tracks', '{{"pid":' || pid || ',"pos":1000000}}', 'added', 0, 1, null from {_ADDED_ROWS}
    union all select 'playlists', '{{"pid":' || o_orderkey || '}}', 'changed', 1, 1, 'collaborative'
    from orders where {_FLAGGED.replace("pid", "o_orderkey")}
    union all select 'artists', '{{"artist_key":' || artist_key || '}}', 'changed', 1, 1, 'name'
    from (select distinct artist_key from e where {_RENAMED})""")
def differing_rows(spark, sf_dir):
    """The rows behind the differences, with what differs; read from the differing slices alone."""
    found = rows_that_differ(spark, *_two_copies(spark, sf_dir), ORDERS)
    return found.select("tbl", "key", "kind", "n_left", "n_right", F.array_join("columns", ",").alias("columns"))
