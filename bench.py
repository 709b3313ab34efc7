"""Time the headline queries and the phases of a load, and print one line of JSON.

The nested documents are staged first, untimed, as they are the input. Every query runs once
to warm up and then three times; the median counts. Results are written to Spark's no-op
sink, so that every row and column is computed.

The phases stand beside published figures for loads of 6.7 million entries: reading and
exploding, the three dimensions from the text on, the constraints, the whole load by one job
and by a stream. ``BENCH_COPIES=11`` times them on that many entries: the lines and orders of
the largest tables as often, with shifted keys.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from flatloom.operators.flatten import wide_entries  # noqa: E402
from flatloom.plans.normalize import constraint_report, load, normalize  # noqa: E402
from flatloom.plans.run import load_by_stream  # noqa: E402
from flatloom.queries import QUERIES  # noqa: E402
from flatloom.scratch import new_path, stages  # noqa: E402
from flatloom.session import local_session  # noqa: E402
from flatloom.sources.documents import read_documents, stream_documents  # noqa: E402
from flatloom.sources.star_schema import ORDERS, staged_documents, table  # noqa: E402

HEADLINE = [
    "load_tables",
    "entries_wide",
    "flatten_playlists",
    "playlists_projection",
    "nested_roundtrip",
    "fact_projection",
    "dedup_min_region",
    "dedup_min_nation",
    "dedup_min_supplier",
    "dedup_any_supplier",
    "dedup_min_part_violating",
    "dedup_last_wins_in_slice",
    "dedup_first_slice_wins",
    "distinct_on_first_row",
    "new_keys_only",
    "expected_counts",
    "two_level_equals_one_level",
    "pk_dups_lineitem",
    "fk_orphans_clean",
    "fd_violations_part",
    "hottest_keys",
    "containing_playlists",
    "median_by_group",
    "latest3_median",
    "throughput_report",
    "stream_new_keys",
]
REPEATS = 3


def to_nowhere(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_time(job, repeats: int = REPEATS) -> float:
    seconds = []
    for _ in range(repeats + 1):
        start = time.perf_counter()
        job()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def enlarged(spark, sf_dir: str, copies: int) -> str:
    """The star-schema tables with orders and line items ``copies`` times over."""
    root = new_path(spark, "enlarged")
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] + 1
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        n = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_n")
        rows = table(spark, sf_dir, name).select("*", n).withColumn(key, F.col(key) + F.col("_n") * last)
        rows.drop("_n").write.parquet(f"{root}/{name}.parquet")
    for name in ("supplier", "nation", "region"):
        table(spark, sf_dir, name).write.parquet(f"{root}/{name}.parquet")
    return root


def phases(spark, sf_dir: str, repeats: int) -> dict[str, float]:
    """Seconds per phase, each from the text on unless it starts from loaded tables."""
    source = staged_documents(spark, sf_dir)

    def docs(*fields):
        return read_documents(spark, source, ORDERS, "lines", *fields)

    def three_dimensions():
        with stages(spark):
            tables = normalize(docs(), ORDERS)
            for d in ORDERS.dimensions:
                to_nowhere(tables[d.table])

    def by_stream():
        with stages(spark):
            files = max(1, spark.sparkContext.defaultParallelism)
            stream = stream_documents(spark, source, ORDERS, "lines", files)
            load_by_stream(stream, ORDERS, new_path(spark, "stream"), "run", new_path(spark, "state"))

    def by_batch():
        with stages(spark):
            load(docs(), ORDERS, new_path(spark, "tables"))

    loaded = load(docs(), ORDERS, new_path(spark, "loaded"))
    return {
        "read_explode": median_time(lambda: to_nowhere(wide_entries(docs(), ORDERS)), repeats),
        "three_dimensions_with_parse": median_time(three_dimensions, repeats),
        "constraints": median_time(lambda: constraint_report(loaded, ORDERS).collect(), repeats),
        "load_batch": median_time(by_batch, repeats),
        "load_stream": median_time(by_stream, repeats),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    copies = int(os.environ.get("BENCH_COPIES") or 1)
    spark = local_session(cores)
    if copies > 1:
        sf_dir = enlarged(spark, sf_dir, copies)
    start = time.perf_counter()
    staged_documents(spark, sf_dir)
    staging = time.perf_counter() - start
    seconds = {}
    for name in HEADLINE if copies == 1 else []:
        seconds[name] = median_time(lambda n=name: to_nowhere(QUERIES[n].run(spark, sf_dir)))
    entries = table(spark, sf_dir, "lineitem").count()
    by_phase = phases(spark, sf_dir, REPEATS if copies == 1 else 1)
    result = {
        "metric": "headline_total" if copies == 1 else "load_phases",
        "value": round(sum((seconds or by_phase).values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1] if copies == 1 else f"{copies} copies",
        "cores": cores,
        "entries": entries,
        "phases": by_phase,
        "rows_per_s": {name: round(entries / s) for name, s in by_phase.items()},
        "staging_s": round(staging, 3),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
