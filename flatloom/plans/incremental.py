"""Loading document batches one after the other, each exactly once.

A store is a folder that becomes the target: every batch writes its facts and parents there,
in a ``batch=<name>`` folder of their tables, its share of the dimensions next to it, and last
of all its part of the load log. Readers take only batches that the log names. A batch that is
lost half-way leaves nothing visible, and running it again replaces what it had written.
Dimensions are kept as one partial winner per batch and key; ``finalize`` collapses them over
all batches and writes nothing else, so a fact is written once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from flatloom.operators.checks import mismatches
from flatloom.operators.dedup import dimension_table, first_slice_wins, min_per_column, new_rows, smallest_row
from flatloom.operators.flatten import entry_rows, fact_rows, parent_rows
from flatloom.plans.normalize import (
    LOAD_RULES,
    PLACED_RULES,
    PLACES,
    attribute_combinations,
    dated_entries,
    parse_once,
    placed_dimension,
    placed_winners,
)
from flatloom.schemas import Dimension, DocumentModel
from flatloom.scratch import empty, new_path, remove, stages, written
from flatloom.sinks.tables import read_tables, together, write_tables
from flatloom.sources.documents import SOURCE

LOG = "load_log"
PARTIALS = "partials"
BATCH = "batch"
LOG_SCHEMA = StructType(
    [StructField("unit", StringType()), StructField("n_entries", LongType()), StructField(BATCH, StringType())]
)
# So many parts of the log are merged into one.
LOG_PARTS = 100


def _path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _folders(spark: SparkSession, path: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return [status.getPath().getName() for status in found if status.isDirectory()]


@dataclass(frozen=True)
class Store:
    """Where the tables of a model are collected under one rule for the dimensions."""

    spark: SparkSession
    root: str
    model: DocumentModel
    rule: str = "min"

    def __post_init__(self) -> None:
        if self.rule not in LOAD_RULES:
            raise ValueError(f"rule must be one of {LOAD_RULES}, not {self.rule!r}")

    def _dimension(self, table: str) -> Dimension | None:
        return next((d for d in self.model.dimensions if d.table == table), None)

    def _schema(self, table: str) -> StructType:
        schema = self.model.table_schema(table)
        if self._dimension(table) is None or self.rule not in PLACED_RULES:
            return schema
        kinds = (LongType(), IntegerType(), IntegerType())
        return StructType([*schema.fields, *map(StructField, PLACES, kinds)])

    def path(self, table: str) -> str:
        """Where batches put their rows: facts and parents right into the target."""
        return f"{self.root}/{PARTIALS}/{table}" if self._dimension(table) is not None else f"{self.root}/{table}"

    def exists(self) -> bool:
        return _path_exists(self.spark, f"{self.root}/{LOG}")

    def create(self) -> None:
        """Empty tables and an empty log; anything that was there is replaced."""
        remove(self.spark, *[f"{self.root}/{table}" for table in self.model.tables], f"{self.root}/{PARTIALS}")

        def write(table: str) -> None:
            empty(self.spark, self._schema(table)).write.mode("overwrite").parquet(f"{self.path(table)}/{BATCH}=none")

        together(self.spark, *[partial(write, table) for table in self.model.tables])
        remove(self.spark, f"{self.root}/{LOG}")
        empty(self.spark, LOG_SCHEMA).write.parquet(f"{self.root}/{LOG}/none")

    def write(self, batch: str, tables: dict[str, DataFrame]) -> None:
        """Write, or write again, what one batch adds to the given tables."""

        def write(table: str) -> None:
            rows = tables[table].select(*self._schema(table).fieldNames())
            rows.write.mode("overwrite").parquet(f"{self.path(table)}/{BATCH}={batch}")

        together(self.spark, *[partial(write, table) for table in tables])

    def close_batch(self, batch: str, units: DataFrame) -> None:
        """Name a batch and its files in the log: from here on it is visible."""
        rows = units.select("unit", "n_entries").withColumn(BATCH, F.lit(batch))
        rows.select(*LOG_SCHEMA.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/{LOG}/{batch}")
        parts = _folders(self.spark, f"{self.root}/{LOG}")
        if len(parts) > LOG_PARTS:
            # Readers drop what is named twice, so a merge that is cut short does no harm.
            merged = f"{self.root}/{LOG}/merged-{batch}"
            self.log().coalesce(1).write.mode("overwrite").parquet(merged)
            remove(self.spark, *[f"{self.root}/{LOG}/{p}" for p in parts])

    def log(self) -> DataFrame:
        """(unit, n_entries, batch) of every delivered file."""
        reader = self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.root}/{LOG}").distinct()

    def finished(self) -> DataFrame:
        """The batches that the log names, as of now.

        They are written, so that their small size is known and rows need not be shuffled
        by batch to be compared with them.
        """
        return written(self.log().select(BATCH).distinct(), "finished-batches")

    def read(self, table: str, finished: DataFrame | None = None) -> DataFrame:
        """All rows of finished batches, with the batch that brought them."""
        schema = StructType([*self._schema(table).fields, StructField(BATCH, StringType())])
        stored = self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(self.path(table))
        return stored.join(self.finished() if finished is None else finished, BATCH, "left_semi")

    def _collapsed(self, rows: DataFrame, dim: Dimension) -> DataFrame:
        attrs = [c for c in self.model.table_schema(dim.table).fieldNames() if c != dim.key]
        if self.rule in PLACED_RULES:
            return placed_winners(rows, dim.key, attrs, self.rule)
        collapse = min_per_column if self.rule == "min" else smallest_row
        return collapse(rows, dim.key, attrs)

    def tables(self) -> dict[str, DataFrame]:
        """The target tables: facts and parents as they are, dimensions collapsed over all batches.

        All of them show the same batches.
        """
        finished = self.finished()
        found = {}
        for table in self.model.tables:
            rows = self.read(table, finished).drop(BATCH)
            dim = self._dimension(table)
            found[table] = rows if dim is None else self._collapsed(rows, dim)
        return found

    def drop_unfinished(self) -> None:
        """Remove what batches that the log does not name have left in the tables."""
        known = {f"{BATCH}={row[0]}" for row in self.log().select(BATCH).distinct().collect()} | {f"{BATCH}=none"}
        for table in self.model.tables:
            left = [f for f in _folders(self.spark, self.path(table)) if f.startswith(f"{BATCH}=") and f not in known]
            remove(self.spark, *[f"{self.path(table)}/{f}" for f in left])


def units_to_load(units: DataFrame, log: DataFrame) -> DataFrame:
    """Distinct units that the log does not name."""
    return units.select("unit").distinct().join(log.select("unit").distinct(), "unit", "left_anti")


def delivered_files(parents: DataFrame, model: DocumentModel) -> DataFrame:
    """(source_file, n_entries, unit): what each file of a batch delivers.

    A delivery is known by the name of its file and by what the file holds: the number of its
    entries and a sum of hashes over its parents, in whatever order. The same file delivered
    again, from wherever, is the same unit; another file of the same name is another unit.
    """
    size = F.greatest(F.coalesce(F.size(model.entries), F.lit(0)), F.lit(0))
    columns = [F.col(c) for c in parents.columns if c != SOURCE]
    content = F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string")
    files = parents.groupBy(SOURCE).agg(
        F.sum(size).cast("long").alias("n_entries"), F.count("*").cast("string").alias("_n"), content.alias("_content")
    )
    name = F.element_at(F.split(SOURCE, "/"), -1)
    unit = F.concat_ws(":", name, "_n", F.col("n_entries").cast("string"), "_content")
    return files.select(SOURCE, "n_entries", unit.alias("unit"))


def load_batch(docs: DataFrame, store: Store, batch: str) -> None:
    """Add one batch of documents to all tables, leaving out files that were delivered before."""
    log = store.log()
    if not log.filter(F.col(BATCH) == batch).isEmpty():
        return
    model = store.model
    by_place = store.rule in PLACED_RULES
    with stages(store.spark):
        parsed = parse_once(docs, model, ordinals=by_place)
        # A file delivered twice within the batch counts once.
        files = delivered_files(parsed.rows(model.parent_columns, model.entry_columns), model)
        once = files.groupBy("unit").agg(F.min(F.struct(SOURCE, "n_entries")).alias("_file")).select("unit", "_file.*")
        fresh = written(once.join(log.select("unit"), "unit", "left_anti"), "batch-units")

        def only_fresh(rows: DataFrame) -> DataFrame:
            return rows.join(fresh.select(SOURCE), SOURCE, "left_semi")

        facts = entry_rows(only_fresh(parsed.rows([model.parent_key], model.fact_columns)), model)
        wide = entry_rows(only_fresh(parsed.rows([model.parent_key], model.entry_columns)), model, by_place)
        stage = new_path(store.spark, "batch-combinations")

        def write_dimensions() -> None:
            if by_place:
                dated = dated_entries(wide)
                store.write(batch, {d.table: placed_dimension(dated, d, store.rule, True) for d in model.dimensions})
                return
            distinct = attribute_combinations(wide, model)
            distinct.write.parquet(stage)
            combinations = store.spark.read.schema(distinct.schema).parquet(stage)
            rule = "min" if store.rule == "min" else "smallest"
            dims = model.dimensions
            store.write(batch, {d.table: dimension_table(combinations, d, rule, distinct_first=False) for d in dims})

        def write_others() -> None:
            parents = parent_rows(only_fresh(parsed.rows(model.parent_columns)), model)
            store.write(batch, {model.parent_table: parents, model.fact_table: fact_rows(facts, model)})

        together(store.spark, write_dimensions, write_others)
        # The log comes last.
        store.close_batch(batch, fresh)


def finalize(store: Store) -> dict[str, DataFrame]:
    """Write the dimensions, collapsed over all batches, next to the facts and parents in the store.

    What unfinished batches have left is removed, so that the target holds finished ones only.
    """
    store.drop_unfinished()
    with stages(store.spark):
        tables = store.tables()
        write_tables({d.table: tables[d.table] for d in store.model.dimensions}, store.root, store.model)
    return read_tables(store.spark, store.root, store.model)


def fact_count_mismatch(store: Store) -> DataFrame:
    """Empty if the fact table holds exactly the entries that the batches reported."""
    tbl = F.lit(store.model.fact_table).alias("tbl")
    reported = store.log().agg(F.coalesce(F.sum("n_entries"), F.lit(0)).alias("n")).select(tbl, "n")
    actual = store.read(store.model.fact_table).agg(F.count("*").alias("n")).select(tbl, "n")
    return mismatches(reported, actual)


def insert_ignore(
    table_path: str, incoming: DataFrame, key: str, slice_column: str | None = None, order_by: Sequence[str] = ()
) -> None:
    """Append one row per key that a stored table lacks; rows it has stay as they are.

    With ``slice_column`` and ``order_by``, of several new rows the last one written in the earliest
    slice is taken, as inserts slice by slice would; these columns are stored only if the table has
    them. Without an order it is the smallest row.
    """
    spark = incoming.sparkSession
    stored = spark.read.parquet(table_path)
    attrs = [c for c in stored.columns if c != key]
    with stages(spark):
        if slice_column is None:
            fresh = new_rows(incoming, stored, key, attrs)
        else:
            winners = first_slice_wins(incoming, key, attrs, slice_column, order_by)
            fresh = winners.join(stored.select(key).distinct(), key, "left_anti")
        written(fresh, "insert-ignore").select(*stored.columns).write.mode("append").parquet(table_path)
