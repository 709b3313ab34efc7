"""Counts: per table, expected from the raw input, duplication and the most repeated keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tbl, n), one row per table."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def expected_counts(entries: DataFrame, distinct: Mapping[str, str], total: str = "entries") -> DataFrame:
    """One row: all entries, and the distinct values of the named columns, in one pass.

    Counting several distinct columns multiplies the rows by their number, so equal
    combinations are collapsed and counted first.
    """
    combinations = entries.groupBy(*distinct.values()).agg(F.count("*").alias("_n"))
    columns = [F.count_distinct(F.col(column)).alias(name) for name, column in distinct.items()]
    return combinations.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(total), *columns)


def duplication(entries: DataFrame, key: str) -> DataFrame:
    """One row (entries, uniq, ratio): how often a key repeats on average."""
    per_key = entries.groupBy(key).agg(F.count("*").alias("n"))
    totals = per_key.agg(F.sum("n").alias("entries"), F.count(key).alias("uniq"))
    ratio = F.try_divide(F.col("entries").cast("double"), F.col("uniq"))
    return totals.withColumn("ratio", ratio)


def hottest_keys(entries: DataFrame, key: str | Sequence[str], k: int) -> DataFrame:
    """The ``k`` most repeated keys; equal counts are ordered by key."""
    names = [key] if isinstance(key, str) else list(key)
    return entries.groupBy(*names).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *names).limit(k)


def parents_containing(facts: DataFrame, entry_key: str, value, parent_key: str) -> DataFrame:
    """Which parents hold a given entry; the equality reaches the file scan."""
    return facts.filter(F.col(entry_key) == F.lit(value)).select(parent_key).distinct()
