"""Load a folder of slice files: ``python -m flatloom SOURCE TARGET [--results DIR]``.

Under ``spark-submit`` the session takes master and settings from there.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from flatloom.plans.normalize import LOAD_RULES
from flatloom.plans.run import FILES_PER_BATCH, run_folder
from flatloom.schemas import PLAYLISTS
from flatloom.sinks.tables import append_run_results, publish_over_jdbc, read_tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="flatloom", description=__doc__)
    parser.add_argument("source", help="folder with slice files")
    parser.add_argument("target", help="folder for the five tables; replaced")
    parser.add_argument("--way", choices=("batch", "stream"), default="batch")
    parser.add_argument("--rule", choices=LOAD_RULES, default="min")
    parser.add_argument("--slices", type=int, help="only the first slices, by number")
    parser.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH, help="of a stream")
    parser.add_argument("--bytes-per-batch", type=int, help="of a stream, instead of a number of files")
    parser.add_argument("--state", help="folder for a stream's progress; with it a stopped run is taken up again")
    parser.add_argument("--repeat", type=int, default=1)
    parser.add_argument("--results", help="folder to append run results to, as CSV")
    parser.add_argument("--jdbc", metavar="URL", help="database to append the tables of a good run to")
    parser.add_argument("--jdbc-property", metavar="KEY=VALUE", action="append", default=[])
    args = parser.parse_args()
    spark = SparkSession.builder.appName("flatloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for rep in range(1, args.repeat + 1):
        record = run_folder(
            spark,
            args.source,
            args.target,
            PLAYLISTS,
            args.way,
            args.rule,
            args.slices,
            rep=rep,
            files_per_batch=args.files_per_batch,
            bytes_per_batch=args.bytes_per_batch,
            state=args.state,
        )
        record.show(truncate=False)
        if args.results:
            append_run_results(record, args.results)
    if args.jdbc and record.first().status == "OK":
        properties = dict(p.split("=", 1) for p in args.jdbc_property)
        publish_over_jdbc(read_tables(spark, args.target, PLAYLISTS), args.jdbc, properties)


if __name__ == "__main__":
    main()
