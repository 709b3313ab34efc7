"""Reading nested documents, flattening and typing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatloom.functions import first_number, json_field
from flatloom.operators.flatten import (
    entries_per_parent,
    entry_rows,
    explode_parents,
    fact_rows,
    parent_rows,
    parents_without_entries,
    wide_entries,
)
from flatloom.operators.undeclared import undeclared_document_fields, undeclared_fields
from flatloom.plans.normalize import ParsedParents, parse_once
from flatloom.queries.registry import WIDE, query
from flatloom.schemas import DocumentModel
from flatloom.scratch import new_path
from flatloom.sources.documents import CORRUPT, SOURCE, documents_from_text, quarantined, read_documents, read_with_quarantine
from flatloom.sources.star_schema import ORDERS, PART_ENTRIES, input_identity, staged_documents, table


_parsed: dict[tuple, ParsedParents] = {}


def documents(spark: SparkSession, sf_dir: str, parent_fields=None, entry_fields=()) -> DataFrame:
    """The staged documents, converting only the named fields."""
    path = staged_documents(spark, sf_dir)
    return read_documents(spark, path, ORDERS, "lines", parent_fields, entry_fields)


def entries_from_text(spark: SparkSession, sf_dir: str, *entry_fields: str) -> DataFrame:
    """Wide entries straight from the text, converting only the named fields if any are given."""
    if not entry_fields:
        return wide_entries(documents(spark, sf_dir), ORDERS)
    return wide_entries(documents(spark, sf_dir, ["pid"], entry_fields), ORDERS)


def entries(spark: SparkSession, sf_dir: str, *entry_fields: str) -> DataFrame:
    """Wide entries with the named fields, from the text as it was parsed once for all consumers."""
    key = input_identity(spark, sf_dir)
    if key not in _parsed:
        _parsed[key] = parse_once(documents(spark, sf_dir), ORDERS)
    return _parsed[key].entries(*entry_fields).drop(SOURCE)


@query(f"select * from {WIDE}")
def entries_wide(spark, sf_dir):
    return entries_from_text(spark, sf_dir)


@query(f"select pid, pos, track_key from {WIDE}")
def fact_projection(spark, sf_dir):
    return fact_rows(entries_from_text(spark, sf_dir, "pos", "track_key"), ORDERS)


@query(f"select pid, pos, track_key, track_name from {WIDE}")
def flatten_entries(spark, sf_dir):
    return entries_from_text(spark, sf_dir, "pos", "track_key", "track_name")


@query("select o_orderkey pid, o_orderpriority name from orders")
def flatten_playlists(spark, sf_dir):
    parents = explode_parents(documents(spark, sf_dir, ["pid", "name"], None), ORDERS)
    return parent_rows(parents, ORDERS)


@query("""
    select o_orderkey pid, o_orderpriority name,
        case when o_orderstatus <> 'P' then o_orderpriority end description,
        o_orderstatus = 'F' collaborative, cast(epoch(o_orderdate) as bigint) modified_epoch
    from orders""")
def playlists_projection(spark, sf_dir):
    parents = explode_parents(documents(spark, sf_dir, ORDERS.parent_columns, None), ORDERS)
    rows = parent_rows(parents, ORDERS)
    return rows.withColumn("modified_epoch", F.unix_seconds("modified_at")).drop("modified_at")


@query("""
    select o_orderkey pid from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""")
def playlists_without_entries(spark, sf_dir):
    parents = explode_parents(documents(spark, sf_dir, ["pid"], ["pos"]), ORDERS)
    return parents_without_entries(parents, ORDERS)


@query("""
    select o_orderkey pid, e.pos from orders
    left join (select l_orderkey, row_number() over (partition by l_orderkey) - 1 pos_any,
        cast(pos_any as int) pos from lineitem) e on l_orderkey = o_orderkey""")
def flatten_entries_outer(spark, sf_dir):
    parents = explode_parents(documents(spark, sf_dir, ["pid"], ["pos"]), ORDERS)
    return entry_rows(parents, ORDERS, outer=True).select("pid", "pos")


@query("""
    select o_orderkey pid, count(l_orderkey) n_entries
    from orders left join lineitem on l_orderkey = o_orderkey group by 1""")
def nested_roundtrip(spark, sf_dir):
    parents = explode_parents(documents(spark, sf_dir, ["pid"], ["pos"]), ORDERS)
    return entries_per_parent(parents, ORDERS)


@query(f"select track_key, count(*) n from {WIDE} group by 1")
def whole_text_entries(spark, sf_dir):
    """Documents held as text, parsed by column expression instead of by the file reader."""
    path = staged_documents(spark, sf_dir)
    narrow = DocumentModel(**{**vars(ORDERS), "schema": ORDERS.pruned(["pid"], ["track_key"])})
    docs = documents_from_text(spark.read.text(path), narrow)
    return wide_entries(docs, narrow).groupBy("track_key").agg(F.count("*").alias("n"))


@query("select event_id, cast(json_extract(props, '$.k') as int) k from events")
def json_props_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", json_field(F.col("props"), "k", "int").alias("k"))


@query("""
    select page_id, n
    from (select page_id, try_cast(regexp_extract(url, '/([0-9]+)', 1) as int) n from pages)
    where n is not null order by n, page_id limit 20""")
def numeric_order_first_n(spark, sf_dir):
    numbered = table(spark, sf_dir, "pages").select("page_id", first_number(F.col("url")).alias("n"))
    return numbered.filter(F.col("n").isNotNull()).orderBy("n", "page_id").limit(20)


@query(f"""
    with sizes as (
        select o_orderstatus, count(l_orderkey) n, greatest(1, ceil(count(l_orderkey) / {PART_ENTRIES})) docs
        from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_orderstatus)
    select 'good' outcome, cast(sum(docs) as bigint) documents, cast(sum(n) as bigint) entries
    from sizes where o_orderstatus <> 'P'
    union all
    select 'rejected', cast(sum(docs) as bigint), 0 from sizes where o_orderstatus = 'P'""")
def quarantine_split(spark, sf_dir):
    """Pending orders arrive as documents that were cut off half-way."""
    parents = explode_parents(documents(spark, sf_dir), ORDERS).select(*ORDERS.parent_schema.fieldNames())
    text = F.to_json(F.struct(F.array(F.struct(*parents.columns)).alias(ORDERS.parents)))
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pid"), "o_orderstatus")
    lines = parents.join(status, "pid").select(
        F.when(F.col("o_orderstatus") == "P", F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int")))
        .otherwise(text)
        .alias("value")
    )
    path = new_path(spark, "damaged")
    lines.write.text(path)
    found = read_with_quarantine(spark, path, ORDERS, "lines")
    size = F.coalesce(F.size("tracks"), F.lit(0)).cast("long")
    good = explode_parents(found.good, ORDERS).agg(
        F.count("*").alias("documents"), F.coalesce(F.sum(size), F.lit(0)).alias("entries")
    )
    rejected = found.rejects.agg(F.count("*").alias("documents"), F.lit(0).cast("long").alias("entries"))
    return good.select(F.lit("good").alias("outcome"), "*").unionByName(
        rejected.select(F.lit("rejected").alias("outcome"), "*")
    )


@query("""
    select 'good' outcome, count(*) files, cast(sum(n) as bigint) entries
    from (select o_orderkey, o_orderstatus, count(l_orderkey) n
        from orders left join lineitem on l_orderkey = o_orderkey group by 1, 2)
    where o_orderstatus = 'O'
    union all select 'rejected', count(*), 0 from orders where o_orderstatus <> 'O'""")
def several_documents_rejected(spark, sf_dir):
    """Files with a second document, or with text after the first, next to files with one.

    Every part of an order is a file of its own, which bounds it as the staged documents are; its
    other fields stand before the array of parents. The parts count as one file of the order.
    """
    parents = explode_parents(documents(spark, sf_dir), ORDERS).select(*ORDERS.parent_schema.fieldNames())
    whole = parents.select("pid", F.array(F.struct(*parents.columns)).alias(ORDERS.parents))
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pid"), "o_orderstatus")
    one = F.to_json(F.struct(F.struct(F.col("pid").alias("version")).alias("info"), ORDERS.parents))
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(one, F.lit("\n"), one))
        .when(F.col("o_orderstatus") == "P", F.concat(one, F.lit(" end")))
        .otherwise(one)
    )
    files = whole.join(status, "pid").select(text.alias("value"), F.col("pid").cast("string").alias(SOURCE))
    outcome = F.when(F.col(CORRUPT).isNull(), "good").otherwise("rejected").alias("outcome")
    n = F.aggregate(
        F.coalesce(F.col(ORDERS.parents), F.array()), F.lit(0), lambda a, p: a + F.coalesce(F.size(p["tracks"]), F.lit(0))
    )
    found = quarantined(files, ORDERS).select(outcome, SOURCE, n.cast("long").alias("n"))
    orders = found.groupBy("outcome", SOURCE).agg(F.sum("n").alias("n"))
    return orders.groupBy("outcome").agg(F.count("*").alias("files"), F.sum("n").alias("entries"))


@query("select '$.k' path, 'BIGINT' type, count(*) n from events")
def undeclared_props(spark, sf_dir):
    """The fields of the event properties, with types and counts, without a schema."""
    return undeclared_fields(table(spark, sf_dir, "events"), "props")


@query(f"""
    with parents as (select o_orderkey pid, 0 part from orders union select pid, pos // 200 from {WIDE})
    select '$.playlists[*].mood' path, 'STRING' type, count(*) n from parents where pid % 10 = 7
    union all select '$.playlists[*].mood', 'BIGINT', count(*) from parents where pid % 100 = 3 having count(*) > 0
    union all select '$.playlists[*].tracks[*].added', 'OBJECT<by: BIGINT, via: ARRAY<STRING>>', count(*) from {WIDE} where pos = 1""")
def undeclared_in_documents(spark, sf_dir):
    """Fields planted in the documents that the model does not name: a schema's reader would pass over them."""
    text = F.col("value")
    for pattern, planted in (
        (r'"pid":([0-9]*7),', r'"pid":$1,"mood":"blue",'),
        (r'"pid":((?:[0-9]*0)?3),', r'"pid":$1,"mood":5,'),
        (r'"pos":1,', r'"pos":1,"added":{"by":3,"via":["x"]},'),
    ):
        text = F.regexp_replace(text, pattern, planted)
    texts = spark.read.text(staged_documents(spark, sf_dir)).select(text.alias("value"))
    return undeclared_document_fields(texts, "value", ORDERS)
