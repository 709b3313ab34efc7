"""Two copies of a model's tables compared by value, reading only the slices that differ.

A sliced copy holds each table in a folder per slice, and next to it the tree of digests of
what was written. Facts and parents are sliced by their parent's key, dimensions by a hash of theirs.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from flatloom.operators.checks import CheckFailed
from flatloom.operators.digests import LANES, differing_rows, differing_slices, digest_tree, slice_digests
from flatloom.schemas import DocumentModel
from flatloom.scratch import empty
from flatloom.sinks.tables import together

SLICE = "slice"
WIDTH = 1000
BUCKETS = 256
DIGESTS = "digests"
_TREE = StructType([StructField(c, LongType()) for c in ("node", "n", *LANES, "level")])


def _slice(model: DocumentModel, table: str, width: int, buckets: int) -> Column:
    key = model.keys()[table][0]
    kind = model.table_schema(table)[key].dataType.typeName()
    if key == model.parent_key and kind in ("integer", "long"):
        return F.coalesce(F.floor(F.col(key) / width).cast("long"), F.lit(-1).cast("long"))
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long")


def write_sliced(
    tables: dict[str, DataFrame], root: str, model: DocumentModel, width: int = WIDTH, buckets: int = BUCKETS
) -> None:
    """Write the tables slice by slice, then their digests, computed from what has been written.

    A slice of many rows is written by several tasks. Rows without a parent key share a slice.
    """
    spark = next(iter(tables.values())).sparkSession

    def write(table: str) -> None:
        rows = tables[table].select(*model.table_schema(table).fieldNames())
        sliced = rows.withColumn(SLICE, _slice(model, table, width, buckets)).hint("rebalance", SLICE)
        sliced.write.mode("overwrite").partitionBy(SLICE).parquet(f"{root}/{table}")
        write_digests(spark, root, model, table)

    together(spark, *[partial(write, table) for table in tables])


def write_digests(spark: SparkSession, root: str, model: DocumentModel, table: str) -> None:
    """Write, or write again, the tree of digests of one table of a sliced copy."""
    tree = digest_tree(slice_digests(read_sliced(spark, root, model, table), SLICE))
    tree.sortWithinPartitions("node").write.mode("overwrite").partitionBy("level").parquet(f"{root}/{DIGESTS}/{table}")


def read_sliced(spark: SparkSession, root: str, model: DocumentModel, table: str) -> DataFrame:
    schema = StructType([*model.table_schema(table).fields, StructField(SLICE, LongType())])
    return spark.read.schema(schema).parquet(f"{root}/{table}")


def _differing(spark: SparkSession, left: str, right: str, table: str) -> DataFrame:
    trees = [spark.read.schema(_TREE).parquet(f"{root}/{DIGESTS}/{table}") for root in (left, right)]
    return differing_slices(*trees)


def slices_that_differ(spark: SparkSession, left: str, right: str, model: DocumentModel) -> DataFrame:
    """(tbl, slice, n_left, n_right) over all tables of two sliced copies; only digests are read."""
    found = [_differing(spark, left, right, t).select(F.lit(t).alias("tbl"), "*") for t in model.tables]
    return reduce(DataFrame.unionByName, found)


def rows_that_differ(spark: SparkSession, left: str, right: str, model: DocumentModel) -> DataFrame:
    """(tbl, key, kind, n_left, n_right, columns, left_row, right_row): what differs, by name.

    ``key`` is the primary key as JSON. Only the folders of slices whose digests differ are read:
    Catalyst prunes the others while it runs, as the slices are a small side with a filter.
    """
    found = []
    for table in model.tables:
        slices = _differing(spark, left, right, table)
        if slices.isEmpty():
            continue
        wanted = slices.filter((F.col("n_left") > 0) | (F.col("n_right") > 0)).select(SLICE)
        columns = model.table_schema(table).fieldNames()
        sides = [read_sliced(spark, root, model, table).join(wanted, SLICE).select(*columns) for root in (left, right)]
        key = list(model.keys()[table])
        rows = differing_rows(*sides, key)
        name = F.to_json(F.struct(*key), {"ignoreNullFields": "false"}).alias("key")
        found.append(rows.select(F.lit(table).alias("tbl"), name, *[c for c in rows.columns if c not in key]))
    if not found:
        fields = "tbl string, key string, kind string, n_left long, n_right long, columns array<string>, left_row string, right_row string"
        return empty(spark, StructType.fromDDL(fields))
    return reduce(DataFrame.unionByName, found)


def require_same_values(spark: SparkSession, left: str, right: str, model: DocumentModel) -> None:
    """Stop the run, naming a few rows, if the copies differ; equal copies cost the digests alone."""
    sample = rows_that_differ(spark, left, right, model).limit(5).collect()
    if sample:
        raise CheckFailed(f"values differ: {[row.asDict() for row in sample]}")
