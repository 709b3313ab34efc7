"""Parquet tables (the default), a JDBC option and the run-result file."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from flatloom.schemas import RUN_RESULT, DocumentModel
from flatloom.scratch import empty


def table_path(root: str, table: str) -> str:
    return f"{root}/{table}"


def append_by_name(df: DataFrame, path: str, schema: StructType) -> None:
    """Append with columns matched by name and written in the table's order."""
    df.select(*schema.fieldNames()).write.mode("append").parquet(path)


def reset_tables(spark: SparkSession, root: str, model: DocumentModel) -> None:
    """Replace every target table by an empty one with its declared columns."""
    for table in model.tables:
        rows = empty(spark, model.table_schema(table))
        rows.write.mode("overwrite").parquet(table_path(root, table))


def together(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Submit independent jobs at the same time, so that one fills the gaps of another."""

    @inheritable_thread_target(spark)
    def run(job: Callable[[], None]) -> None:
        job()

    # Each job sees the scratch block of the caller.
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(copy_context().run, run, job) for job in jobs]
        for future in futures:
            future.result()


def write_tables(tables: Mapping[str, DataFrame], root: str, model: DocumentModel) -> None:
    """Replace the given tables."""
    spark = next(iter(tables.values())).sparkSession

    def write(table: str) -> None:
        columns = model.table_schema(table).fieldNames()
        tables[table].select(*columns).write.mode("overwrite").parquet(table_path(root, table))

    together(spark, *[partial(write, table) for table in tables])


def read_tables(spark: SparkSession, root: str, model: DocumentModel) -> dict[str, DataFrame]:
    """The target tables under ``root``, with their declared schemas.

    Tables that a store has filled have a folder per batch, which is no column of theirs.
    """
    found = {}
    for table in model.tables:
        schema = model.table_schema(table)
        found[table] = spark.read.schema(schema).parquet(table_path(root, table)).select(*schema.fieldNames())
    return found


def write_for_lookup(facts: DataFrame, path: str, entry_key: str, *tie: str) -> None:
    """Lay the facts out by entry key, so that a lookup skips most row groups.

    The other key columns join the range key: a hot entry then spans several files.
    """
    order = [entry_key, *tie]
    facts.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def append_over_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Append to a database table with batched inserts; the caller brings driver and URL.

    ``numPartitions`` among the properties bounds the number of connections.
    """
    # Batch size and rewriting of batched inserts.
    options = {"batchsize": "10000", "reWriteBatchedInserts": "true"} | dict(properties)
    df.write.mode("append").jdbc(url, table, properties=options)


def publish_over_jdbc(tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str]) -> None:
    """Append all tables to a database: what others refer to comes first, the facts last."""
    for table, df in tables.items():
        append_over_jdbc(df, url, table, properties)


def append_run_results(runs: DataFrame, path: str) -> None:
    """Append run results as CSV, always in the declared column order."""
    runs.select(*RUN_RESULT.fieldNames()).write.mode("append").option("header", "true").csv(path)


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """Run results with their declared types; a header in another order fails the job."""
    reader = spark.read.schema(RUN_RESULT).option("header", "true")
    return reader.option("enforceSchema", "false").option("mode", "FAILFAST").csv(path)
