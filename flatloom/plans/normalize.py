"""Documents to dimension, parent and fact tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flatloom.functions import slice_range_start
from flatloom.operators.checks import key_violations, not_null_violations, orphan_keys, total_violations
from flatloom.operators.dedup import dimension_table, first_slice_wins, last_write_wins
from flatloom.operators.flatten import (
    ENTRY_ORD,
    PARENT_ORD,
    entry_rows,
    explode_parents,
    fact_rows,
    parent_rows,
)
from flatloom.schemas import Dimension, DocumentModel
from flatloom.scratch import new_path, stages, write_new
from flatloom.sinks.tables import read_tables, together, write_tables
from flatloom.sources.documents import SOURCE

SLICE = "slice_start"
LOAD_RULES = ("min", "smallest", "any", "first_slice", "last")
# The rules under which the places of the rows decide.
PLACED_RULES = ("first_slice", "last")


def dimension_columns(model: DocumentModel) -> list[str]:
    used = {d.key for d in model.dimensions} | {src for d in model.dimensions for src in d.attributes.values()}
    return [c for c in model.entry_columns if c in used]


def attribute_combinations(entries: DataFrame, model: DocumentModel, *extra: str) -> DataFrame:
    """The distinct attribute rows behind all dimensions, next to the ``extra`` columns.

    One hash aggregate shrinks the entries once; the dimensions then start from a set
    that does not grow with the number of copies. Minima over it equal those over all entries.
    """
    return entries.select(*extra, *dimension_columns(model)).distinct()


@dataclass(frozen=True)
class ParsedParents:
    """Exploded parents, written once as nested Parquet so that text is parsed a single time.

    Catalyst does not narrow a struct below an explode to several of its fields, so the
    wanted fields are named when the table is read. ``only`` is a condition on bookkeeping columns.
    """

    spark: SparkSession
    path: str
    schema: StructType
    model: DocumentModel
    only: Column | None = None

    def rows(self, parent_fields: Iterable[str], entry_fields: Iterable[str] | None = None) -> DataFrame:
        """Parents with the named fields; ``entry_fields=None`` leaves the entries unread."""
        narrow = self.model.pruned(parent_fields, entry_fields)[self.model.parents].dataType.elementType
        extra = [f for f in self.schema if f.name not in self.model.parent_schema.fieldNames()]
        found = self.spark.read.schema(StructType([*extra, *narrow.fields])).parquet(self.path)
        return found if self.only is None else found.filter(self.only)

    def part(self, only: Column) -> ParsedParents:
        """The parents for which a condition on bookkeeping columns holds."""
        return replace(self, only=only if self.only is None else self.only & only)

    def entries(self, *entry_fields: str, ordinals: bool = False) -> DataFrame:
        """Wide entries with the named fields."""
        return entry_rows(self.rows([self.model.parent_key], entry_fields), self.model, ordinals)

    def parents(self) -> DataFrame:
        return parent_rows(self.rows(self.model.parent_columns), self.model)

    def facts(self) -> DataFrame:
        return fact_rows(self.entries(*self.model.fact_columns), self.model)


def parse_once(docs: DataFrame, model: DocumentModel, ordinals: bool = False) -> ParsedParents:
    """Explode and write the parents of all documents."""
    return written_parents(explode_parents(docs, model, ordinals), model)


def written_parents(parents: DataFrame, model: DocumentModel) -> ParsedParents:
    """Write exploded parents, with whatever bookkeeping columns they have."""
    return ParsedParents(parents.sparkSession, write_new(parents, "parents"), parents.schema, model)


def _check_rule(rule: str) -> None:
    if rule not in LOAD_RULES:
        raise ValueError(f"rule must be one of {LOAD_RULES}, not {rule!r}")


def _parent_and_fact_tables(parsed: ParsedParents) -> dict[str, DataFrame]:
    return {parsed.model.parent_table: parsed.parents(), parsed.model.fact_table: parsed.facts()}


def _dimension_tables(parsed: ParsedParents, rule: str, stage: str) -> dict[str, DataFrame]:
    """The dimensions under a rule; ``stage`` is where their common distinct rows are written."""
    model = parsed.model
    if rule in PLACED_RULES:
        dated = dated_entries(parsed.entries(*dimension_columns(model), ordinals=True))
        return {d.table: placed_dimension(dated, d, rule) for d in model.dimensions}
    distinct = attribute_combinations(parsed.entries(*dimension_columns(model)), model)
    distinct.write.parquet(stage)
    rows = parsed.spark.read.schema(distinct.schema).parquet(stage)
    return {d.table: dimension_table(rows, d, rule, distinct_first=False) for d in model.dimensions}


# The places that decide which row of a key stands, if slices are inserted one by one.
PLACES = (SLICE, PARENT_ORD, ENTRY_ORD)


def dated_entries(entries: DataFrame) -> DataFrame:
    """Entries with the slice they came from as a number."""
    return entries.withColumn(SLICE, slice_range_start(F.col(SOURCE)))


def placed_dimension(dated: DataFrame, dim: Dimension, rule: str, with_places: bool = False) -> DataFrame:
    """The dimension under a rule of places, with the winners' places if asked for: what slices
    inserted one by one leave ("first_slice"), or what the last of all writes leaves ("last")."""
    named = {out: src for out, src in dim.attributes.items() if out != dim.key}
    attrs = [F.col(src).alias(out) for out, src in named.items()]
    rows = dated.select(dim.key, *attrs, *PLACES)
    return placed_winners(rows, dim.key, [*named, *PLACES] if with_places else list(named), rule)


def placed_winners(rows: DataFrame, key: str, kept: list[str], rule: str) -> DataFrame:
    """The winner of each key by its places: slice, parent, entry."""
    if rule == "last":
        return last_write_wins(rows, key, kept, PLACES)
    return first_slice_wins(rows, key, kept, SLICE, PLACES[1:])


def normalize(docs: DataFrame, model: DocumentModel, rule: str = "min") -> dict[str, DataFrame]:
    """All target tables of the model, as DataFrames over the parsed parents.

    ``rule`` is one of "min", "smallest", "any", "first_slice" for what slices inserted one after
    the other leave behind, or "last" for the last write over all slices by number.
    """
    _check_rule(rule)
    parsed = parse_once(docs, model, ordinals=rule in PLACED_RULES)
    stage = new_path(docs.sparkSession, "combinations")
    tables = _parent_and_fact_tables(parsed) | _dimension_tables(parsed, rule, stage)
    return {t: tables[t].select(*model.table_schema(t).fieldNames()) for t in model.tables}


def load(docs: DataFrame, model: DocumentModel, root: str, rule: str = "min") -> dict[str, DataFrame]:
    """Replace all tables under ``root`` and return them as read back.

    The intermediate tables are removed once the target is written, or the load has failed.
    """
    _check_rule(rule)
    spark = docs.sparkSession
    with stages(spark):
        parsed = parse_once(docs, model, ordinals=rule in PLACED_RULES)
        stage = new_path(spark, "combinations")
        together(
            spark,
            lambda: write_tables(_parent_and_fact_tables(parsed), root, model),
            lambda: write_tables(_dimension_tables(parsed, rule, stage), root, model),
        )
    return read_tables(spark, root, model)


def constraint_report(tables: dict[str, DataFrame], model: DocumentModel) -> DataFrame:
    """(kind, target, violations) for every not-null, primary-key and foreign-key rule of the model."""
    parts = []

    def add(kind: str, target, found: DataFrame) -> None:
        name = target if not isinstance(target, str) else F.lit(target)
        parts.append(found.select(F.lit(kind).alias("kind"), name.alias("target"), "violations"))

    for table, df in tables.items():
        target = F.concat(F.lit(f"{table}."), F.col("col"))
        add("not_null", target, not_null_violations(df, model.required(table)))
        key = model.keys()[table]
        add("primary_key", f"{table}({', '.join(key)})", total_violations(key_violations(df, key)))
    for ref in model.references:
        orphans = orphan_keys(tables[ref.table], ref.column, tables[ref.parent], ref.parent_column)
        add("foreign_key", f"{ref.table}.{ref.column} -> {ref.parent}", total_violations(orphans, "n"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
