"""Constraint checks, run in bulk after the load; each is one aggregate over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(Exception):
    """Raised when a check that must hold does not."""


def not_null_violations(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, violations): NULLs in each column, counted in one pass."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "col", "violations")


def key_violations(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary key: keys that occur more than once or contain a NULL, with their number of rows."""
    has_null = F.lit(False)
    for c in key:
        has_null = has_null | F.col(c).isNull()
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | has_null)


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign key: (key, n) for values the parent lacks; NULLs are allowed.

    The child shrinks to its distinct keys with their counts before the join, so the join
    never sees a hot key twice.
    """
    present = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias(foreign_key))
    return present.join(known, foreign_key, "left_anti")


def dependency_violations(rows: DataFrame, key: str, attrs: Sequence[str], name: str = "n_values") -> DataFrame:
    """Functional dependency: keys with more than one combination of the attributes, and how many.

    NULL counts as a value, with one attribute as with several.
    """
    combination = F.struct(*attrs)
    return rows.groupBy(key).agg(F.count_distinct(combination).alias(name)).filter(F.col(name) > 1)


def broken_dependencies(rows: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """The same keys without the number: smallest and largest combination differ.

    One shuffle instead of two, and NULL counts as a value.
    """
    low, high = F.min(F.struct(*attrs)).alias("_low"), F.max(F.struct(*attrs)).alias("_high")
    return rows.groupBy(key).agg(low, high).filter(~F.col("_low").eqNullSafe(F.col("_high"))).select(key)


def total_violations(found: DataFrame, weight: str | None = None) -> DataFrame:
    """One row (violations) for a set of findings, or the sum of their ``weight``."""
    n = F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return found.agg(n.cast("long").alias("violations"))


def mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(tbl, expected, actual) where the counts differ; tables that only ``actual`` has are ignored."""
    left = expected.select("tbl", F.col("n").alias("expected"))
    right = actual.select("tbl", F.col("n").alias("actual"))
    return left.join(right, "tbl", "left").filter(~F.col("expected").eqNullSafe(F.col("actual")))


def load_status(load_failed: Column, constraint_violations: Column, mismatched: Column) -> Column:
    """The outcome of a load; an earlier failure hides the later ones."""
    # The four outcomes.
    return (
        F.when(load_failed, "LOAD_FAILED")
        .when(constraint_violations, "CONSTRAINTS_FAILED")
        .when(mismatched, "MISMATCH")
        .otherwise("OK")
    )


def require_empty(found: DataFrame, what: str) -> None:
    """Stop the run, naming a few findings, if there are any."""
    sample = found.limit(5).collect()
    if sample:
        raise CheckFailed(f"{what}: {[row.asDict() for row in sample]}")
