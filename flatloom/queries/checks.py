"""Constraint checks on the tables, with and without violations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from flatloom.operators import checks
from flatloom.operators.counts import table_counts
from flatloom.operators.dependencies import discovered_dependencies
from flatloom.operators.flatten import explode_parents, parent_rows
from flatloom.plans.normalize import constraint_report, normalize
from flatloom.queries.nested import documents, entries
from flatloom.queries.registry import WIDE, query
from flatloom.sources.star_schema import ORDERS, slice_of, table


@query("select count(*) violations from lineitem where not exists (select 1 from part where p_partkey = l_partkey)")
def fk_orphans_clean(spark, sf_dir):
    found = checks.orphan_keys(table(spark, sf_dir, "lineitem"), "l_partkey", table(spark, sf_dir, "part"), "p_partkey")
    return checks.total_violations(found, "n")


@query("""
    select l_partkey, count(*) n from lineitem
    where not exists (select 1 from part where p_partkey = l_partkey and p_size <= 25) group by 1""")
def fk_orphans_filtered_parent(spark, sf_dir):
    parts = table(spark, sf_dir, "part").filter("p_size <= 25")
    return checks.orphan_keys(table(spark, sf_dir, "lineitem"), "l_partkey", parts, "p_partkey")


@query("select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1")
def pk_dups_lineitem(spark, sf_dir):
    return checks.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select count(*) violations from (select 1 from conversations group by conv_id, turn having count(*) > 1)")
def pk_ok_conversations(spark, sf_dir):
    found = checks.key_violations(table(spark, sf_dir, "conversations"), ["conv_id", "turn"])
    return checks.total_violations(found)


@query(f"select count(*) violations from (select 1 from {WIDE} group by pid, pos having count(*) > 1)")
def pk_ok_entries(spark, sf_dir):
    return checks.total_violations(checks.key_violations(entries(spark, sf_dir, "pos"), ["pid", "pos"]))


@query("""
    select l_partkey, count(distinct l_suppkey) n_supp from lineitem
    group by 1 having count(distinct l_suppkey) > 1""")
def fd_violations_part(spark, sf_dir):
    return checks.dependency_violations(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_suppkey"], "n_supp")


@query(f"select count(*) violations from (select track_key from {WIDE} group by 1 having count(distinct album_key) > 1)")
def fd_ok_supplier(spark, sf_dir):
    wide = entries(spark, sf_dir, "track_key", "album_key")
    return checks.total_violations(checks.broken_dependencies(wide, "track_key", ["album_key"]))


@query("""
    select 'description' col,
        count(*) filter (case when o_orderstatus <> 'P' then o_orderpriority end is null) violations
    from orders
    union all select 'name', count(*) filter (o_orderpriority is null) from orders""")
def not_null_violations(spark, sf_dir):
    parents = explode_parents(documents(spark, sf_dir, ["pid", "name", "description"], None), ORDERS)
    return checks.not_null_violations(parent_rows(parents, ORDERS), ["description", "name"])


@query("""
    with actual as (
        select 'orders' tbl, count(*) n from orders union all select 'lineitem', count(*) from lineitem),
    expected as (select tbl, n + (case when tbl = 'lineitem' then 1 else 0 end) n from actual)
    select tbl, e.n expected, a.n actual from expected e join actual a using (tbl)
    where e.n is distinct from a.n""")
def validate_counts(spark, sf_dir):
    """A count that is off by one shows up; one that agrees does not."""
    actual = table_counts({name: table(spark, sf_dir, name) for name in ("orders", "lineitem")})
    off = F.when(F.col("tbl") == "lineitem", 1).otherwise(0)
    return checks.mismatches(actual.withColumn("n", F.col("n") + off), actual)


@query("""
    select slice_id, case when pk_dups > 800 then 'CONSTRAINTS_FAILED'
        when n_entries < 4000 then 'MISMATCH' else 'OK' end status
    from (
        select slice_id, cast(sum(n) as bigint) n_entries, count(*) filter (n > 1) pk_dups
        from (select l_orderkey // 1000 slice_id, l_orderkey, l_linenumber, count(*) n
            from lineitem group by 1, 2, 3) group by 1)""")
def load_status(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = lines.groupBy(slice_of("l_orderkey").alias("slice_id"), "l_orderkey", "l_linenumber")
    slices = (
        keys.agg(F.count("*").alias("n"))
        .groupBy("slice_id")
        .agg(F.sum("n").alias("n_entries"), F.count_if(F.col("n") > 1).alias("pk_dups"))
    )
    status = checks.load_status(F.col("n_entries").isNull(), F.col("pk_dups") > 800, F.col("n_entries") < 4000)
    return slices.select("slice_id", status.alias("status"))


@query(f"""
    with e as {WIDE},
    artists as (select artist_key, min(artist_name) name from e group by 1),
    albums as (select album_key, min(album_name) name, min(artist_key) artist_key from e group by 1),
    tracks as (select track_key, min(track_name) name, min(album_key) album_key from e group by 1)
    select 'not_null' kind, 'artists.artist_key' target, count(*) filter (artist_key is null) violations from artists
    union all select 'not_null', 'artists.name', count(*) filter (name is null) from artists
    union all select 'not_null', 'albums.album_key', count(*) filter (album_key is null) from albums
    union all select 'not_null', 'albums.name', count(*) filter (name is null) from albums
    union all select 'not_null', 'albums.artist_key', count(*) filter (artist_key is null) from albums
    union all select 'not_null', 'tracks.track_key', count(*) filter (track_key is null) from tracks
    union all select 'not_null', 'tracks.name', count(*) filter (name is null) from tracks
    union all select 'not_null', 'tracks.album_key', count(*) filter (album_key is null) from tracks
    union all select 'not_null', 'playlists.pid', count(*) filter (o_orderkey is null) from orders
    union all select 'not_null', 'playlists.name', count(*) filter (o_orderpriority is null) from orders
    union all select 'not_null', 'playlists.collaborative', count(*) filter (o_orderstatus is null) from orders
    union all select 'not_null', 'playlists.modified_at', count(*) filter (o_orderdate is null) from orders
    union all select 'not_null', 'playlist_tracks.pid', count(*) filter (pid is null) from e
    union all select 'not_null', 'playlist_tracks.pos', count(*) filter (pos is null) from e
    union all select 'not_null', 'playlist_tracks.track_key', count(*) filter (track_key is null) from e
    union all select 'primary_key', 'artists(artist_key)', count(*) - count(distinct artist_key) from artists
    union all select 'primary_key', 'albums(album_key)', count(*) - count(distinct album_key) from albums
    union all select 'primary_key', 'tracks(track_key)', count(*) - count(distinct track_key) from tracks
    union all select 'primary_key', 'playlists(pid)', count(*) - count(distinct o_orderkey) from orders
    union all select 'primary_key', 'playlist_tracks(pid, pos)', count(*) - count(distinct (pid, pos)) from e
    union all select 'foreign_key', 'albums.artist_key -> artists', count(*) from albums
        where artist_key not in (select artist_key from artists)
    union all select 'foreign_key', 'tracks.album_key -> albums', count(*) from tracks
        where album_key not in (select album_key from albums)
    union all select 'foreign_key', 'playlist_tracks.pid -> playlists', count(*) from e
        where pid not in (select o_orderkey from orders)
    union all select 'foreign_key', 'playlist_tracks.track_key -> tracks', count(*) from e
        where track_key not in (select track_key from tracks)""")
def constraints_of_loaded_tables(spark, sf_dir):
    """Every declared rule, checked on the tables made from the documents."""
    return constraint_report(normalize(documents(spark, sf_dir), ORDERS), ORDERS)


@query(f"""
    with e as {WIDE},
    bad as (
        select case when pid % 7 = 0 then null else pid end pid, pos, track_key from e
        union all select pid, pos, track_key from e where pid % 5 = 0 and pid % 7 <> 0),
    tracks as (select distinct track_key from e where track_key % 3 <> 0),
    keys as (select pid, pos, count(*) n from bad group by 1, 2)
    select 'not_null' kind, 'playlist_tracks.pid' target, count(*) violations from bad where pid is null
    union all select 'primary_key', 'playlist_tracks(pid, pos)', count(*) from keys where n > 1 or pid is null
    union all select 'foreign_key', 'playlist_tracks.track_key -> tracks', count(*) from bad
        where track_key not in (select track_key from tracks)""")
def constraints_with_violations(spark, sf_dir):
    """Tables with planted faults: keys lost, entries repeated, tracks removed; rules that hold are left out.

    A primary key counts violating keys, the other rules count rows.
    """
    tables = normalize(documents(spark, sf_dir), ORDERS)
    facts = tables[ORDERS.fact_table]
    lost = facts.withColumn("pid", F.when(F.col("pid") % 7 != 0, F.col("pid")))
    repeated = facts.filter("pid % 5 = 0 and pid % 7 != 0")
    broken = tables | {ORDERS.fact_table: lost.unionByName(repeated), "tracks": tables["tracks"].filter("track_key % 3 != 0")}
    return constraint_report(broken, ORDERS).filter("violations > 0")


_SEARCHED = ("l_suppkey", "s_name", "s_nationkey", "s_acctbal", "l_partkey", "l_returnflag", "l_linestatus")


def _all_dependencies(columns: tuple[str, ...], max_determinant: int) -> str:
    """Every set of columns against every other column, then those of which no smaller set does as well."""
    sets = [x for n in range(max_determinant + 1) for x in combinations(sorted(columns), n)]
    tests = [
        f"select [{', '.join(repr(c) for c in x)}]::varchar[] x, '{a}' a, "
        f"(select count(*) from (select distinct {', '.join(x) or '1'} from j)) = "
        f"(select count(*) from (select distinct {', '.join([*x, a])} from j)) ok"
        for x in sets for a in columns if a not in x
    ]
    return f"""
        with j as (select distinct {', '.join(columns)} from lineitem join supplier on l_suppkey = s_suppkey),
        t as ({' union all '.join(tests)}), good as (select x, a from t where ok)
        select array_to_string(x, ',') determinant, a dependent from good
        where not exists (select 1 from good g where g.a = good.a and len(g.x) < len(good.x) and list_has_all(good.x, g.x))"""


@query(_all_dependencies(_SEARCHED, 2))
def dependencies_found(spark, sf_dir):
    """What determines what among line items and their suppliers, found by a search with pruning."""
    supplier = table(spark, sf_dir, "supplier")
    rows = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    found = discovered_dependencies(rows, _SEARCHED, 2)
    return found.select(F.array_join("determinant", ",").alias("determinant"), "dependent")
