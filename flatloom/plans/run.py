"""A whole run: load, check the constraints, compare the counts, keep a record."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from flatloom.functions import bounded_rate
from flatloom.operators.checks import load_status, mismatches
from flatloom.operators.counts import table_counts
from flatloom.operators.flatten import explode_parents
from flatloom.plans.incremental import Store, finalize
from flatloom.plans.normalize import constraint_report, load
from flatloom.schemas import RUN_RESULT, DocumentModel
from flatloom.scratch import new_path, stages
from flatloom.sources.documents import SOURCE, read_documents, stream_documents
from flatloom.sources.slices import among_first_slices, slice_files, slice_paths
from flatloom.streaming.ingest import ingest

LOGGER = logging.getLogger(__name__)

# What a failed job raises: some errors of the JVM reach Python as they are.
JOB_FAILED = (PySparkException, Py4JJavaError)
# Fixed value: slices per micro-batch.
FILES_PER_BATCH = 100


def expected_table_counts(docs: Callable[..., DataFrame], model: DocumentModel) -> DataFrame:
    """(tbl, n) counted in the documents themselves, by another way than the load takes.

    ``docs`` reads the documents with the given parent and entry fields. The text is parsed
    once: parents are exploded, counted, and their entries collapsed to combinations of keys.
    """
    keys = {d.table: d.key for d in model.dimensions}
    heads = [model.parent_key, *([model.part] if model.part else [])]
    parents = explode_parents(docs(heads, list(keys.values())), model)
    is_parent = F.coalesce(F.col(model.part), F.lit(0)) == 0 if model.part else F.lit(True)
    # The place of an entry tells the parent itself, at 0, from what follows it.
    entries = F.coalesce(F.col(model.entries), F.array())
    entry = model.pruned(heads, list(keys.values()))[model.parents].dataType.elementType[model.entries].dataType.elementType
    both = F.concat(F.array(F.lit(None).cast(entry)), entries.cast(ArrayType(entry)))
    rows = parents.select(is_parent.alias("_head"), F.posexplode(both).alias("_at", "_e"))
    counted = rows.groupBy((F.col("_at") > 0).alias("_entry"), "_head", *[F.col("_e")[k].alias(k) for k in keys.values()])
    combinations = counted.agg(F.count("*").alias("_n"))
    distinct = [F.count_distinct(F.when(F.col("_entry"), F.col(k))).alias(t) for t, k in keys.items()]

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))

    facts = total(F.col("_entry")).alias(model.fact_table)
    heads_found = total(~F.col("_entry") & F.col("_head")).alias(model.parent_table)
    names = [*keys, model.fact_table, model.parent_table]
    return combinations.agg(*distinct, facts, heads_found).unpivot([], names, "tbl", "n")


def load_by_stream(
    docs: DataFrame, model: DocumentModel, root: str, run: str, checkpoint: str, rule: str = "min"
) -> dict[str, DataFrame]:
    """Load a document stream batch by batch into ``root``, then collapse the dimensions once.

    With a ``root`` and a ``checkpoint`` that an earlier call has left, the load goes on where
    that one stopped.
    """
    store = Store(docs.sparkSession, root, model, rule)
    if not store.exists():
        store.create()
    ingest(docs, store, checkpoint, run).awaitTermination()
    return finalize(store)


def _record(spark: SparkSession, values: dict) -> DataFrame:
    """One run result; whatever a failed run did not get to is zero."""
    blank = {f.name: 0 for f in RUN_RESULT}
    blank |= {f.name: 0.0 for f in RUN_RESULT if f.dataType.typeName() == "double"}
    row = blank | {"run_at": datetime.now(UTC).isoformat(timespec="seconds")} | values
    return spark.createDataFrame([tuple(row[f.name] for f in RUN_RESULT)], RUN_RESULT).coalesce(1)


def timed_run(
    spark: SparkSession,
    name: str,
    model: DocumentModel,
    expected: DataFrame,
    run_load: Callable[[], dict[str, DataFrame]],
    slices: int = 0,
    rep: int = 1,
) -> DataFrame:
    """Run a load and return its record. A failure is an outcome, not an abort.

    The reason of a failure, and the rules that the tables violate, go to the log.
    """
    values = {"loader": name, "slices": slices, "rep": rep}
    start = time.perf_counter()
    try:
        tables = run_load()
    except JOB_FAILED as reason:
        LOGGER.error("%s: the load failed: %s", name, reason)
        return _record(spark, values | {"status": "LOAD_FAILED"})
    values["load_s"] = round(time.perf_counter() - start, 1)
    start = time.perf_counter()
    try:
        # One row per rule of the model.
        violated = constraint_report(tables, model).filter("violations > 0").collect()
    except JOB_FAILED as reason:
        LOGGER.error("%s: the constraints could not be checked: %s", name, reason)
        return _record(spark, values | {"status": "CONSTRAINTS_FAILED"})
    if violated:
        found = ", ".join(f"{r.kind} {r.target}: {r.violations}" for r in violated)
        LOGGER.error("%s: constraints are violated: %s", name, found)
        return _record(spark, values | {"status": "CONSTRAINTS_FAILED"})
    values["constraints_s"] = round(time.perf_counter() - start, 1)
    values["total_s"] = round(values["load_s"] + values["constraints_s"], 1)
    try:
        # Five counts, one per table.
        actual = {row.tbl: row.n for row in table_counts(tables).collect()}
        found = spark.createDataFrame(list(actual.items()), "tbl string, n long")
        differing = mismatches(expected, found).collect()
    except JOB_FAILED as reason:
        LOGGER.error("%s: the tables could not be counted: %s", name, reason)
        return _record(spark, values | {"status": "MISMATCH"})
    if differing:
        LOGGER.error("%s: counts differ: %s", name, [r.asDict() for r in differing])
    status = load_status(F.lit(False), F.lit(False), F.lit(bool(differing)))
    values |= {tbl: n for tbl, n in actual.items() if tbl in RUN_RESULT.fieldNames()}
    rate = F.coalesce(bounded_rate(F.col(model.fact_table), F.col("load_s"), 0), F.lit(0)).cast("long")
    record = _record(spark, values | {"status": "OK"})
    return record.withColumn("status", status).withColumn("rows_per_s", rate).select(*RUN_RESULT.fieldNames())


def run_folder(
    spark: SparkSession,
    source: str,
    target: str,
    model: DocumentModel,
    way: str = "batch",
    rule: str = "min",
    limit: int | None = None,
    layout: str = "file",
    rep: int = 1,
    files_per_batch: int = FILES_PER_BATCH,
    bytes_per_batch: int | None = None,
    state: str | None = None,
) -> DataFrame:
    """Load a folder of slice files into ``target`` and return the record of the run.

    ``way`` is "batch" for one job over all files or "stream" for micro-batches of so many files,
    or of ``bytes_per_batch``. ``limit`` takes the first slices by number. With ``state``, a folder
    for the stream's progress, a run that was stopped is taken up again: files that ``target`` has
    are not loaded twice. Without it the target is made anew.
    """
    if way not in {"batch", "stream"}:
        raise ValueError(f"way must be 'batch' or 'stream', not {way!r}")
    if layout != "file" and limit is not None:
        raise ValueError("a limit counts slice files")
    paths = slice_paths(spark, source, limit)

    def docs(parent_fields=None, entry_fields=()):
        return read_documents(spark, paths, model, layout, parent_fields, entry_fields)

    def by_batch():
        return load(docs(), model, target, rule)

    def by_stream():
        only = None if limit is None else among_first_slices(spark, source, F.col(SOURCE), limit)
        files = stream_documents(spark, source, model, layout, files_per_batch, bytes_per_batch, only)
        with stages(spark):
            if state is None:
                Store(spark, target, model, rule).create()
            return load_by_stream(files, model, target, "run", state or new_path(spark, "stream-state"), rule)

    try:
        expected = expected_table_counts(docs, model).collect()
    except JOB_FAILED:
        # The load will fail on the same document, and be recorded.
        expected = []
    expected = spark.createDataFrame(expected, "tbl string, n long")
    n_slices = slice_files(spark, source, limit).count()
    chosen = by_batch if way == "batch" else by_stream
    return timed_run(spark, f"{way}_{rule}", model, expected, chosen, n_slices, rep)
