"""Row numbers and chunk numbers that stay spread out when one key, or the whole list, is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatloom.scratch import written

# monotonically_increasing_id keeps the row in the low 33 bits, the partition above.
_ROW_BITS = 33
# So many rows are shuffled into one task, which sorts them in memory.
TASK_ROWS = 1 << 20


def positions(rows: DataFrame, order_by: Sequence[str], name: str = "pos") -> DataFrame:
    """Number all rows from 0 in sorted order without bringing them into one task.

    The rows are range-partitioned and sorted once and written with their place in the
    partition, which fixes the boundaries for good. Only the number of rows in each
    partition is added up in one place. Copies of a row are told apart by where they
    lie in a written table, so that a lost task reads them in the same order again.
    """
    tagged = written(rows, "numbered-rows").withColumn("_copy", F.monotonically_increasing_id())
    places = [*order_by, "_copy"]
    ordered = tagged.repartitionByRange(*places).sortWithinPartitions(*places).drop("_copy")
    stage = written(ordered.withColumn("_id", F.monotonically_increasing_id()), "positions")
    stage = stage.withColumn("_range", F.shiftright("_id", _ROW_BITS))
    sizes = stage.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per partition; written, so that its size is known and the rows stay where they are.
    offsets = written(offsets, "range-offsets")
    local = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stage.join(offsets, "_range")
        .withColumn(name, F.col("_offset") + local)
        .select(*rows.columns, name)
    )


def positions_within(rows: DataFrame, key: str, order_by: Sequence[str], name: str = "pos") -> DataFrame:
    """Number the rows of each key from 0 in sorted order; NULL is a key like any other.

    All rows are numbered across ranges, keys first, then those of a key are shifted to start
    at 0. A key with very many rows spans several ranges.
    """
    spread = written(positions(rows, [key, *order_by], "_at"), "spread")
    # One row per key, found with a partial step; written, so that its size decides how it is joined.
    starts = written(spread.groupBy(F.col(key).alias("_key")).agg(F.min("_at").alias("_start")), "starts")
    numbered = spread.join(starts, F.col(key).eqNullSafe(F.col("_key")))
    return numbered.withColumn(name, F.col("_at") - F.col("_start")).select(*rows.columns, name)


def spread_by(rows: DataFrame, total: int, *columns: str) -> DataFrame:
    """Shuffle ``total`` rows by the columns, into more partitions than the session's if these would be too large."""
    tasks = -(-total // TASK_ROWS)
    if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(tasks, *columns)
    return rows.repartition(*columns)


def positions_by_slice(rows: DataFrame, key: str, slice_of_key: Column, order_by: Sequence[str], name: str = "pos") -> DataFrame:
    """The same numbers as ``positions_within``, found with a single shuffle of the rows of all slices but the largest.

    ``slice_of_key`` says which slice of keys a row belongs to. Slices of over ``TASK_ROWS`` rows may hold a key that is
    too large for one task, so their rows are numbered over ranges; no key of the others is. ``order_by`` has
    to tell all rows of a key apart that are not copies of each other.
    """
    sizes = written(rows.groupBy(slice_of_key.alias("_of")).agg(F.count("*").alias("_n")), "slice-sizes")
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    window = Window.partitionBy(key).orderBy(*order_by)

    def by_key(some: DataFrame) -> DataFrame:
        return spread_by(some, total, key).withColumn(name, (F.row_number().over(window) - 1).cast("long"))

    large = sizes.filter(F.col("_n") > TASK_ROWS).select("_of")
    if large.isEmpty():
        return by_key(rows)
    large, same = written(large, "large-slices"), slice_of_key.eqNullSafe(F.col("_of"))
    ranged = positions_within(rows.join(large, same, "left_semi"), key, order_by, name)
    return by_key(rows.join(large, same, "left_anti")).unionByName(ranged)


def chunk_numbers(slices: DataFrame, column: str, chunk_size: int) -> DataFrame:
    """Consecutive groups of ``chunk_size`` slices: (slice, chunk_id)."""
    numbered = positions(slices.select(column).distinct(), [column], "_at")
    return numbered.select(column, F.floor(F.col("_at") / chunk_size).cast("long").alias("chunk_id"))
