"""Comparing tables by value: digests of slices, summed up a tree, and the rows behind a difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatloom.scratch import written

# Children of a node of the tree, and levels above the slices. More slices than these reach have several roots.
FANOUT, LEVELS = 64, 4
# A digest is four sums of 32-bit parts of row hashes, each kept modulo this.
LANES = ("d1", "d2", "d3", "d4")
_MODULUS = 1 << 40
_HALF = (1 << 32) - 1


def _row_hash(columns: Sequence[str], salt: int) -> Column:
    """A hash of all columns. Spark's hash passes over NULL, so that is hashed as a column of its own."""
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(salt), *parts)


def slice_digests(rows: DataFrame, slice_column: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(slice, n, d1..d4): the number of rows of each slice and a digest of their values.

    The digest is a sum over the rows, so neither their order nor their files matter, and a
    repeated row counts twice. The sums have a partial step: a slice with a third of all rows
    arrives as one row per input partition.
    """
    columns = [*(columns or rows.columns)]
    first, second = _row_hash(columns, 1), _row_hash(columns, 2)
    hashed = rows.select(F.col(f"`{slice_column}`").alias("slice"), first.alias("_a"), second.alias("_b"))
    halves = [
        half for c in ("_a", "_b") for half in (F.col(c).bitwiseAND(_HALF), F.shiftrightunsigned(c, 32))
    ]
    sums = [F.pmod(F.sum(half), F.lit(_MODULUS)).alias(lane) for lane, half in zip(LANES, halves, strict=True)]
    return hashed.groupBy("slice").agg(F.count("*").alias("n"), *sums)


def digest_tree(digests: DataFrame) -> DataFrame:
    """(level, node, n, d1..d4): the slices at level 0, and above them nodes that add up 64 each."""
    level = digests.select("slice", "n", *LANES).withColumnRenamed("slice", "node")
    parts = []
    for number in range(LEVELS):
        parts.append(level.select(F.lit(number).alias("level"), "node", "n", *LANES))
        sums = [F.pmod(F.sum(lane), F.lit(_MODULUS)).alias(lane) for lane in LANES]
        above = level.withColumn("node", F.floor(F.col("node") / FANOUT).cast("long"))
        level = above.groupBy("node").agg(F.sum("n").alias("n"), *sums)
    return reduce(DataFrame.unionByName, parts)


def differing_slices(left: DataFrame, right: DataFrame) -> DataFrame:
    """(slice, n_left, n_right) of the slices whose digests differ between two trees.

    Goes down from the roots, into the children of differing nodes only. A slice that one side
    lacks has NULL as its number there.
    """
    nodes = None
    for number in reversed(range(LEVELS)):
        sides = []
        for tree, side in ((left, "left"), (right, "right")):
            level = tree.filter(F.col("level") == number)
            if nodes is not None:
                parent = F.floor(F.col("node") / FANOUT).cast("long")
                level = level.join(nodes.select(F.col("node").alias("_parent")), parent == F.col("_parent"), "left_semi")
            sides.append(level.select("node", *(F.col(c).alias(f"{c}_{side}") for c in ("n", *LANES))))
        both = sides[0].join(sides[1], "node", "full_outer")
        same = reduce(lambda a, b: a & b, [F.col(f"{c}_left").eqNullSafe(F.col(f"{c}_right")) for c in ("n", *LANES)])
        # One row per differing node; written, so that its size decides how it is joined.
        nodes = written(both.filter(~same).select("node", "n_left", "n_right"), "differing-nodes")
    return nodes.withColumnRenamed("node", "slice")


def _surplus(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with how many more of them the left side has than the right; not where they balance."""
    counts = [
        side.select(*(F.col(f"`{c}`") for c in columns), F.lit(sign).cast("long").alias("_sign"))
        for side, sign in ((left, 1), (right, -1))
    ]
    both = counts[0].unionByName(counts[1])
    return both.groupBy(*(f"`{c}`" for c in columns)).agg(F.sum("_sign").alias("_more")).filter("_more != 0")


def differing_rows(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key whose rows differ: the key, kind, n_left, n_right, columns, left_row, right_row.

    ``kind`` is "missing" where only the left side has rows that the other lacks, "added" where
    only the right has, "changed" where both have. ``n_left`` and ``n_right`` count such rows. If it is
    one on both sides, ``columns`` names what differs; ``left_row`` and ``right_row`` are the rows as
    JSON, the smallest if there are several. NULL is a value, in keys as well. Rows that both
    sides have equally often do not count, in whatever order they lie. Nothing is gathered but
    counts and one row per key and side, so a key may have any number of rows.
    """
    columns = left.columns
    values = [c for c in columns if c not in key]
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)), {"ignoreNullFields": "false"})
    surplus = _surplus(left, right, columns)
    only_left, only_right = F.col("_more") > 0, F.col("_more") < 0

    def first(side: Column, what: Column) -> Column:
        return F.min(F.when(side, what))

    texts = [F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`").cast("string")).alias(c) for c in values]
    kept = F.struct(row.alias("row"), F.struct(*texts).alias("values")) if values else F.struct(row.alias("row"))
    found = surplus.groupBy(*(f"`{c}`" for c in key)).agg(
        F.coalesce(F.sum(F.when(only_left, F.col("_more"))), F.lit(0)).alias("n_left"),
        F.coalesce(F.sum(F.when(only_right, -F.col("_more"))), F.lit(0)).alias("n_right"),
        first(only_left, kept).alias("_left"),
        first(only_right, kept).alias("_right"),
    )
    kind = F.when(F.col("n_right") == 0, "missing").when(F.col("n_left") == 0, "added").otherwise("changed")
    changed = [
        F.when(~F.col(f"_left.values.`{c}`").eqNullSafe(F.col(f"_right.values.`{c}`")), F.lit(c)) for c in values
    ]
    named = F.array_compact(F.array(*changed)) if values else F.array().cast("array<string>")
    single = (F.col("n_left") == 1) & (F.col("n_right") == 1)
    return found.select(
        *(f"`{c}`" for c in key), kind.alias("kind"), "n_left", "n_right", F.when(single, named).alias("columns"),
        F.col("_left.row").alias("left_row"), F.col("_right.row").alias("right_row"),
    )
