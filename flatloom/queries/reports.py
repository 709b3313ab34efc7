"""Reports over run results, with orders in the part of the runs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from flatloom.functions import timestamp_to_epoch
from flatloom.operators.reports import latest_runs, throughput, with_label
from flatloom.queries.registry import query
from flatloom.scratch import new_path
from flatloom.sinks.tables import append_run_results, read_run_results
from flatloom.sources.star_schema import table

# Fixed value: entries in the first 100 slices, by which the published rates are computed.
ENTRIES = 6_677_800

_LATEST = """(
    select * from (
        select *, row_number() over (partition by o_orderpriority order by o_orderdate desc, o_orderkey desc) rn
        from orders where o_orderstatus = 'F')
    where rn <= 3)"""


def _finished(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")


def _newest_first():
    return [F.desc("o_orderdate"), F.desc("o_orderkey")]


@query("""
    select o_orderkey, coalesce(m.label, o_orderstatus) label from orders
    left join (values ('F', 'finished'), ('O', 'open')) m(code, label) on o_orderstatus = m.code""")
def label_lookup(spark, sf_dir):
    labels = spark.createDataFrame([("F", "finished"), ("O", "open")], "code string, label string")
    return with_label(table(spark, sf_dir, "orders"), labels, "o_orderstatus").select("o_orderkey", "label")


@query("""
    select m.label, count(*) n from orders
    join (values ('F', 'finished'), ('O', 'open')) m(code, label) on o_orderstatus = m.code group by 1""")
def label_lookup_known_only(spark, sf_dir):
    labels = spark.createDataFrame([("F", "finished"), ("O", "open")], "code string, label string")
    known = with_label(table(spark, sf_dir, "orders"), labels, "o_orderstatus", keep_unknown=False)
    return known.groupBy("label").agg(F.count("*").alias("n"))


@query(f"select o_orderpriority, median(o_totalprice) med, count(*) n from {_LATEST} group by 1")
def latest3_median(spark, sf_dir):
    latest = latest_runs(_finished(spark, sf_dir), "o_orderpriority", _newest_first())
    return latest.groupBy("o_orderpriority").agg(F.median("o_totalprice").alias("med"), F.count("*").alias("n"))


@query(f"""
    select o_orderpriority, median(o_totalprice) med_a, median(o_custkey) med_b,
        {ENTRIES} / median(o_totalprice) rate from {_LATEST} group by 1 order by med_a""")
def throughput_report(spark, sf_dir):
    runs = _finished(spark, sf_dir)
    report = throughput(runs, "o_orderpriority", _newest_first(), "o_totalprice", "o_custkey", F.lit(ENTRIES))
    return report.select(
        "o_orderpriority", F.col("med_load").alias("med_a"), F.col("med_constraints").alias("med_b"), "rate"
    )


@query(f"""
    select o_orderpriority loader, median(o_totalprice) + median(o_custkey) total, count(*) runs
    from {_LATEST} group by 1""")
def report_from_results_file(spark, sf_dir):
    """Runs go to a results file with its fixed column order; the report starts from the file."""
    orders = table(spark, sf_dir, "orders")
    none = F.lit(0).cast("long")
    runs = orders.select(
        # Fixed-width text, so that run times sort as they follow each other.
        F.lpad((timestamp_to_epoch("o_orderdate") + F.lit(10**11)).cast("string"), 13, "0").alias("run_at"),
        F.col("o_orderpriority").alias("loader"),
        F.lit(100).alias("slices"),
        F.col("o_totalprice").alias("load_s"),
        F.col("o_custkey").cast("double").alias("constraints_s"),
        (F.col("o_totalprice") + F.col("o_custkey")).alias("total_s"),
        none.alias("rows_per_s"),
        F.when(F.col("o_orderstatus") == "F", "OK").otherwise("MISMATCH").alias("status"),
        *[none.alias(c) for c in ("artists", "albums", "tracks", "playlists")],
        F.lit(ENTRIES).cast("long").alias("playlist_tracks"),
        # Runs of one second are told apart by their order, whatever the size of the keys.
        F.row_number().over(Window.partitionBy("o_orderpriority", "o_orderdate").orderBy("o_orderkey")).alias("rep"),
    )
    path = new_path(spark, "results")
    append_run_results(runs, path)
    stored = read_run_results(spark, path).filter("slices = 100 and status = 'OK'")
    newest = [F.desc("run_at"), F.desc("rep")]
    report = throughput(stored, "loader", newest, "load_s", "constraints_s", F.col("playlist_tracks"))
    return report.select("loader", "total", "runs")
