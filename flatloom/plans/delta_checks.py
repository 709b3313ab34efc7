"""Constraint checks of a batch against what is stored, without checking the whole tables again.

What is wrong so far is kept as findings: keys that violate a primary key with their number of
rows, and foreign keys that wait for their parent with their number of rows. A batch changes findings
only where its own keys are: new rows against new, new against old, and waiting children against
new parents. Of the stored rows only key columns are read, of stored children nothing at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from flatloom.operators.checks import not_null_violations
from flatloom.schemas import DocumentModel, Reference
from flatloom.scratch import empty, stages, written
from flatloom.sinks.tables import together


@dataclass(frozen=True)
class Rules:
    """What must hold: primary keys and required columns by table, and references between tables."""

    keys: Mapping[str, Sequence[str]]
    references: Sequence[Reference] = ()
    required: Mapping[str, Sequence[str]] | None = None

    @classmethod
    def of(cls, model: DocumentModel) -> Rules:
        return cls(model.keys(), model.references, {t: model.required(t) for t in model.tables})


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns])


def key_findings(new: DataFrame, old: DataFrame, key: Sequence[str], before: DataFrame) -> DataFrame:
    """(key, n): keys with several rows or a NULL after a batch, from those before it.

    Only keys of the batch can change. How often the stored table has them is counted by a
    semi-join on its key columns; a hot key is counted with a partial step.
    """
    key = list(key)
    fresh = new.groupBy(*key).agg(F.count("*").alias("n"))
    # Used three times; written, so that its size decides how the stored keys are joined.
    fresh = written(fresh, "batch-keys")
    had = old.select(*key).alias("o").join(fresh.alias("f"), _same("o", "f", key), "left_semi")
    both = fresh.unionByName(had.groupBy(*key).agg(F.count("*").alias("n")))
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    now = both.groupBy(*key).agg(F.sum("n").alias("n")).filter((F.col("n") > 1) | has_null)
    untouched = before.alias("b").join(fresh.alias("f"), _same("b", "f", key), "left_anti")
    return untouched.unionByName(now)


def waiting_children(
    children: DataFrame, column: str, new_parents: DataFrame, old_parents: DataFrame, parent_column: str, before: DataFrame
) -> DataFrame:
    """(key, n): foreign keys without a parent after a batch, with their number of rows.

    ``before`` are those that wait so far: new parents release them. NULL refers to nothing and never waits.
    """
    arrived = written(new_parents.select(F.col(parent_column).alias("key")).distinct(), "batch-parents")
    known = old_parents.select(F.col(parent_column).alias("key"))
    asked = children.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("n"))
    lacking = asked.join(arrived, "key", "left_anti")
    orphans = lacking.join(known, "key", "left_anti")
    still = before.join(arrived, "key", "left_anti")
    return still.unionByName(orphans).groupBy("key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class BatchChecks:
    """Findings of a growing set of tables, one folder per rule and batch under ``root``."""

    spark: SparkSession
    root: str
    rules: Rules

    def _path(self, rule: str, batch: int) -> str:
        return f"{self.root}/{rule}/batch={batch}"

    def _before(self, rule: str, batch: int, schema: StructType) -> DataFrame:
        if batch == 0:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self._path(rule, batch - 1))

    def _put(self, rule: str, batch: int, found: DataFrame) -> None:
        found.write.mode("overwrite").parquet(self._path(rule, batch))

    def _key(self, table: str, batch: int, new: DataFrame, old: DataFrame) -> None:
        key = list(self.rules.keys[table])
        schema = StructType([*(StructField(c, new.schema[c].dataType) for c in key), StructField("n", LongType())])
        found = key_findings(new, old, key, self._before(f"key-{table}", batch, schema))
        self._put(f"key-{table}", batch, found.select(*key, "n"))

    def _reference(self, ref: Reference, batch: int, new: Mapping[str, DataFrame], old: Mapping[str, DataFrame]) -> None:
        kind = new[ref.parent].schema[ref.parent_column].dataType
        schema = StructType([StructField("key", kind), StructField("n", LongType())])
        rule = f"reference-{ref.table}-{ref.column}"
        before = self._before(rule, batch, schema)
        children = new[ref.table].withColumn(ref.column, F.col(ref.column).cast(kind))
        found = waiting_children(children, ref.column, new[ref.parent], old[ref.parent], ref.parent_column, before)
        self._put(rule, batch, found.select("key", "n"))

    def _required(self, table: str, batch: int, new: DataFrame) -> None:
        schema = StructType([StructField("col", StringType()), StructField("violations", LongType())])
        now = not_null_violations(new, list(self.rules.required[table]))
        both = now.unionByName(self._before(f"required-{table}", batch, schema))
        self._put(f"required-{table}", batch, both.groupBy("col").agg(F.sum("violations").alias("violations")))

    def check(self, batch: int, new: Mapping[str, DataFrame], old: Mapping[str, DataFrame]) -> DataFrame:
        """Take in batch ``batch``, counted from 0: rows ``new`` on top of the stored rows ``old``.

        Returns the report after it, as the whole check would give it. Run again with the same
        rows, a batch gives the same findings: they stand on those of the batch before.
        """
        jobs = [partial(self._key, t, batch, new[t], old[t]) for t in self.rules.keys]
        jobs += [partial(self._reference, r, batch, new, old) for r in self.rules.references]
        jobs += [partial(self._required, t, batch, new[t]) for t in self.rules.required or {}]
        with stages(self.spark):
            together(self.spark, *jobs)
        return self.report(batch)

    def findings(self, rule: str, batch: int) -> DataFrame:
        """The findings of one rule: "key-<table>", "reference-<table>-<column>" or "required-<table>"."""
        return self.spark.read.parquet(self._path(rule, batch))

    def report(self, batch: int) -> DataFrame:
        """(kind, target, violations) after a batch: violating keys, waiting rows, missing values."""
        parts = []
        for table, key in self.rules.keys.items():
            n = F.count("*").cast("long").alias("violations")
            parts.append(("primary_key", F.lit(f"{table}({', '.join(key)})"), self.findings(f"key-{table}", batch).agg(n)))
        for ref in self.rules.references:
            n = F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations")
            found = self.findings(f"reference-{ref.table}-{ref.column}", batch).agg(n)
            parts.append(("foreign_key", F.lit(f"{ref.table}.{ref.column} -> {ref.parent}"), found))
        for table in self.rules.required or {}:
            target = F.concat(F.lit(f"{table}."), "col")
            parts.append(("not_null", target, self.findings(f"required-{table}", batch)))
        rows = [found.select(F.lit(kind).alias("kind"), target.alias("target"), "violations") for kind, target, found in parts]
        return reduce(DataFrame.unionByName, rows)
