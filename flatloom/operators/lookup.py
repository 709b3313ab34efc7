"""Which parents hold any of many keys: a layout by hash bucket, and scans that skip the other buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from flatloom.scratch import written

BUCKET = "key_bucket"
BUCKETS = 256
# So many keys go into the scan's own filter, where Parquet's statistics and Bloom filters meet them.
PUSHED_KEYS = 200


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def write_by_key(facts: DataFrame, path: str, entry_key: str, *tie: str, buckets: int = BUCKETS) -> None:
    """Lay facts out in a folder per bucket of the entry key, sorted by it, with a Bloom filter on it
    (which Parquet leaves out where a dictionary of the keys does the same).

    A bucket of very many rows is written by several tasks, so that a hot key spans several files.
    """
    placed = facts.withColumn(BUCKET, _bucket(entry_key, buckets)).hint("rebalance", BUCKET)
    ordered = placed.sortWithinPartitions(BUCKET, entry_key, *tie)
    writer = ordered.write.mode("overwrite").partitionBy(BUCKET)
    writer.option(f"parquet.bloom.filter.enabled#{entry_key}", "true").parquet(path)


def facts_of_keys(spark: SparkSession, path: str, schema: StructType, keys: DataFrame, entry_key: str, buckets: int = BUCKETS) -> DataFrame:
    """The facts under ``path`` whose entry key is in a table of keys; repeated keys and NULL change nothing.

    Only folders of the keys' buckets are opened. A few keys become the scan's own filter: within
    these folders, row groups whose statistics or Bloom filter exclude them are skipped. More keys are
    joined, and the join prunes the folders while it runs, as long as the keys are few enough to be
    sent to all tasks; a key list beyond that meets most buckets anyway.
    """
    stored = spark.read.schema(StructType([*schema, StructField(BUCKET, LongType())])).parquet(path)
    wanted = keys.select(F.col(keys.columns[0]).cast(schema[entry_key].dataType).alias("_key")).filter("_key is not null").distinct()
    wanted = written(wanted.withColumn("_bucket", _bucket("_key", buckets)), "wanted-keys")
    few = wanted.limit(PUSHED_KEYS + 1).collect()
    if len(few) <= PUSHED_KEYS:
        folders = sorted({r["_bucket"] for r in few})
        found = stored.filter(F.col(BUCKET).isin(folders) & F.col(entry_key).isin([r["_key"] for r in few]))
    else:
        # The filter holds for every key; with it, Catalyst takes the keys as a side worth pruning by.
        side = wanted.filter(F.col("_bucket") >= 0)
        found = stored.join(side, (F.col(BUCKET) == F.col("_bucket")) & (F.col(entry_key) == F.col("_key")), "left_semi")
    return found.select(*schema.fieldNames())


def parents_of_keys(
    spark: SparkSession, path: str, schema: StructType, keys: DataFrame, entry_key: str, parent_key: str, buckets: int = BUCKETS
) -> DataFrame:
    """(entry key, parent key), once each, of the parents that hold any of the keys."""
    return facts_of_keys(spark, path, schema, keys, entry_key, buckets).select(entry_key, parent_key).distinct()
