"""A store in which a slice that is delivered again replaces its older version.

Facts and parents lie in a folder per delivery, with the number of their slice. The log says which
delivery of a slice stands; it is written last, so a delivery that is cut short changes nothing.
Dimensions are kept twice: per slice, the rows it contributes; and per key, the winner, as a row of
the delivery that last touched the key. A correction takes the old version's contributions back:
winners are found again for the keys of the old and of the new version only, and only these are
written. Readers take the newest row of a key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from flatloom.functions import slice_range_start
from flatloom.operators.checks import mismatches
from flatloom.operators.dedup import first_slice_wins, last_write_wins, min_per_column, smallest_row
from flatloom.operators.flatten import ENTRY_ORD, PARENT_ORD, entry_rows, explode_parents, parent_rows
from flatloom.plans.normalize import PLACED_RULES, SLICE, ParsedParents, attribute_combinations, dimension_columns, written_parents
from flatloom.schemas import Dimension, DocumentModel
from flatloom.scratch import empty, remove, stages, written
from flatloom.sinks.tables import read_tables, together, write_tables
from flatloom.sources.documents import SOURCE

DELIVERY = "delivery"
LOG, OUTCOMES, CONTRIBUTIONS, WINNERS, GONE = "load_log", "outcomes", "contributions", "winners", "gone"
# The slice of documents whose file names no number.
NO_SLICE = -1
# Of each parent, found when it is parsed.
DIGEST, N_ENTRIES = "_digest", "_n_entries"
RULES = ("min", "smallest", "first_slice", "last")
LOG_SCHEMA = StructType(
    [
        StructField(SLICE, LongType()),
        StructField("content", StringType()),
        StructField("n_entries", LongType()),
        StructField(DELIVERY, LongType()),
    ]
)
OUTCOME_SCHEMA = StructType([StructField(SLICE, LongType()), StructField("outcome", StringType()), StructField(DELIVERY, LongType())])
_PLACES = [StructField(SLICE, LongType()), StructField(PARENT_ORD, IntegerType()), StructField(ENTRY_ORD, IntegerType())]


@dataclass(frozen=True)
class CorrectableStore:
    """Where a model's tables are kept under one rule for the dimensions, open to corrections."""

    spark: SparkSession
    root: str
    model: DocumentModel
    rule: str = "min"

    def __post_init__(self) -> None:
        if self.rule not in RULES:
            raise ValueError(f"rule must be one of {RULES}, not {self.rule!r}")

    def create(self) -> None:
        """An empty store; anything that was there is replaced."""
        model = self.model
        folders = {table: self._facts_schema(table) for table in (model.parent_table, model.fact_table)}
        for dim in model.dimensions:
            folders[f"{CONTRIBUTIONS}/{dim.table}"] = self._contribution_schema(dim)
            folders[f"{WINNERS}/{dim.table}"] = self._winner_schema(dim)
        for folder, schema in (folders | {LOG: LOG_SCHEMA, OUTCOMES: OUTCOME_SCHEMA}).items():
            remove(self.spark, f"{self.root}/{folder}")
            rows = empty(self.spark, StructType([f for f in schema if f.name != DELIVERY]))
            rows.write.parquet(f"{self.root}/{folder}/{DELIVERY}=0")

    def _facts_schema(self, table: str) -> StructType:
        return StructType([*self.model.table_schema(table), StructField(SLICE, LongType()), StructField(DELIVERY, LongType())])

    def _contribution_schema(self, dim: Dimension) -> StructType:
        return StructType([*self.model.table_schema(dim.table), *_PLACES, StructField(DELIVERY, LongType())])

    def _winner_schema(self, dim: Dimension) -> StructType:
        table = self.model.table_schema(dim.table)
        return StructType([*table, StructField(GONE, BooleanType()), StructField(DELIVERY, LongType())])

    def _read(self, folder: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")

    def log(self) -> DataFrame:
        """(slice, content, n_entries, delivery), one row for each version of a slice."""
        return self._read(LOG, LOG_SCHEMA)

    def outcomes(self) -> DataFrame:
        """(slice, outcome, delivery) of every slice that was delivered: "new", "corrected" or "unchanged"."""
        return self._read(OUTCOMES, OUTCOME_SCHEMA)

    def standing(self) -> DataFrame:
        """(slice, delivery, content) of the newest version of each slice. Written, so that its size is known."""
        newest = self.log().groupBy(SLICE).agg(F.max(F.struct(DELIVERY, "content")).alias("_v"))
        return written(newest.select(SLICE, F.col(f"_v.{DELIVERY}").alias(DELIVERY), F.col("_v.content").alias("content")), "standing")

    def finished(self) -> DataFrame:
        """Deliveries that the log names."""
        return self.log().select(DELIVERY).distinct()

    def facts(self, table: str, standing: DataFrame | None = None) -> DataFrame:
        """Facts or parents of the versions that stand."""
        stands = (self.standing() if standing is None else standing).select(SLICE, DELIVERY)
        rows = self._read(table, self._facts_schema(table)).join(stands, [SLICE, DELIVERY], "left_semi")
        return rows.select(*self.model.table_schema(table).fieldNames())

    def dimension(self, dim: Dimension) -> DataFrame:
        """The newest winner of each key; keys that no standing slice has are gone."""
        columns = self.model.table_schema(dim.table).fieldNames()
        rows = self._read(f"{WINNERS}/{dim.table}", self._winner_schema(dim))
        rows = rows.join(written(self.finished(), "finished"), DELIVERY, "left_semi")
        # A delivery has one row for a key.
        newest = rows.groupBy(dim.key).agg(F.max_by(F.struct(GONE, *columns), DELIVERY).alias("_w"))
        return newest.filter(~F.col(f"_w.{GONE}")).select("_w.*").select(*columns)

    def tables(self) -> dict[str, DataFrame]:
        standing = self.standing()
        found = {d.table: self.dimension(d) for d in self.model.dimensions}
        return found | {t: self.facts(t, standing) for t in (self.model.parent_table, self.model.fact_table)}


def _named(rows: DataFrame, dim: Dimension, *extra: str) -> DataFrame:
    columns = [F.col(dim.key), *(F.col(src).alias(out) for out, src in dim.attributes.items() if out != dim.key)]
    return rows.select(*columns, *extra)


def _collapsed(rows: DataFrame, dim: Dimension, rule: str, by_slice: bool) -> DataFrame:
    """The winner of each key, or, ``by_slice``, what each slice contributes to it, with its place."""
    attrs = [out for out in dim.attributes if out != dim.key]
    key, places = [dim.key, SLICE] if by_slice else [dim.key], [PARENT_ORD, ENTRY_ORD]
    if rule in ("min", "smallest"):
        found = (min_per_column if rule == "min" else smallest_row)(rows, key, attrs)
        return found.withColumns({c: F.lit(None).cast("int") for c in places})
    if by_slice:
        return last_write_wins(rows, key, [*attrs, *places], places)
    if rule == "last":
        return last_write_wins(rows, key, attrs, [SLICE, *places])
    return first_slice_wins(rows, key, attrs, SLICE, places)


def _content() -> Column:
    """A digest of a slice's parents in whatever order."""
    return F.concat_ws(":", F.count("*"), F.sum(F.col(DIGEST).cast("decimal(38,0)")))


def digested(parents: DataFrame, model: DocumentModel) -> ParsedParents:
    """Write parents that carry the number of their slice, each with a digest and its number of entries.

    In the digest NULL is a value.
    """
    parts = [part for c in parents.columns if c in model.parent_schema.fieldNames() for part in (F.col(c).isNull(), F.col(c))]
    size = F.greatest(F.coalesce(F.size(model.entries), F.lit(0)), F.lit(0))
    return written_parents(parents.withColumns({DIGEST: F.xxhash64(*parts), N_ENTRIES: size}), model)


def parse_slices(docs: DataFrame, store: CorrectableStore) -> ParsedParents:
    """The parents of whole slices, parsed and written once for as many deliveries as take them, or a part of them."""
    number = F.coalesce(slice_range_start(F.col(SOURCE)), F.lit(NO_SLICE))
    # The name of a file is read once for a document; parents and entries carry the number.
    numbered = docs.withColumn(SLICE, number).drop(SOURCE)
    return digested(explode_parents(numbered, store.model, store.rule in PLACED_RULES, [SLICE]), store.model)


def deliver(docs: DataFrame | ParsedParents, store: CorrectableStore, delivery: int) -> None:
    """Take in whole slices, each new, corrected or unchanged; ``store.outcomes()`` says which.

    They come as documents, or as parents that ``parse_slices`` or ``digested`` has written.

    Deliveries are numbered from 1; one that the log names is not taken again, and one that was cut
    short leaves nothing visible and can be taken again, as long as no later one has been taken. All documents of a slice, known by the
    first number in the name of its files, come in one delivery; documents whose name has none are a slice of their
    own. A slice whose content is that of its standing version is passed over; another content replaces it:
    facts, parents and contributions. A slice that is not delivered stays as it is.

    Winners are found again for the keys that the replaced versions or the new ones contribute, and
    written for these alone. Contributions are one row per slice and key, however often entries repeat it.
    """
    spark, model = store.spark, store.model
    newest = store.log().agg(F.max(DELIVERY)).first()[0] or 0
    if not store.finished().filter(F.col(DELIVERY) == delivery).isEmpty():
        return
    if delivery < newest:
        raise ValueError(f"delivery {delivery} comes after {newest}: take it under a new number")
    placed = store.rule in PLACED_RULES
    with stages(spark):
        parsed = docs if isinstance(docs, ParsedParents) else parse_slices(docs, store)
        heads = parsed.rows([])
        versions = heads.groupBy(SLICE).agg(_content().alias("content"), F.sum(N_ENTRIES).cast("long").alias("n_entries"))
        standing = store.standing()
        old = standing.select(SLICE, F.col("content").alias("_old"), F.col(DELIVERY).alias("_replaced"))
        changed = F.when(F.col("_old").isNull(), "new").when(F.col("_old") != F.col("content"), "corrected").otherwise("unchanged")
        judged = written(versions.join(old, SLICE, "left").withColumn("outcome", changed), "versions")
        # One row per slice; written, so that its size decides how it is joined.
        taken = written(judged.filter("outcome != 'unchanged'"), "taken")
        mine = taken.select(SLICE, F.lit(delivery).cast("long").alias(DELIVERY))
        after = standing.join(taken, SLICE, "left_anti").select(SLICE, DELIVERY).unionByName(mine)
        after = written(after, "standing-after")
        replaced = taken.filter("_replaced is not null").select(SLICE, F.col("_replaced").alias(DELIVERY))

        def only_taken(rows: DataFrame) -> DataFrame:
            return rows.join(taken.select(SLICE), SLICE, "left_semi")

        def put(rows: DataFrame, folder: str) -> None:
            rows.write.mode("overwrite").parquet(f"{store.root}/{folder}/{DELIVERY}={delivery}")

        def write_parents() -> None:
            put(parent_rows(only_taken(parsed.rows(model.parent_columns)), model, [SLICE]), model.parent_table)

        def write_facts() -> None:
            put(entries(list(model.fact_columns)).select(*model.fact_columns, SLICE), model.fact_table)

        def entries(fields: list[str]) -> DataFrame:
            return entry_rows(only_taken(parsed.rows([model.parent_key], fields)), model, placed, keep=[SLICE])

        def write_dimensions() -> None:
            if placed:
                sources = [entries([d.key, *d.attributes.values()]) for d in model.dimensions]
            else:
                # Copies go first, once for all dimensions: entries repeat their attributes, contributions hardly do.
                once = attribute_combinations(entries(dimension_columns(model)), model, SLICE)
                sources = [written(once, "combinations")] * len(model.dimensions)
            together(spark, *[partial(write_dimension, d, rows) for d, rows in zip(model.dimensions, sources, strict=True)])

        def write_dimension(dim: Dimension, rows: DataFrame) -> None:
            folder, schema = f"{CONTRIBUTIONS}/{dim.table}", store._contribution_schema(dim)
            named = _named(rows, dim, SLICE, *((PARENT_ORD, ENTRY_ORD) if placed else ()))
            per_slice = _collapsed(named, dim, store.rule, by_slice=True)
            put(per_slice.select(*[f.name for f in schema if f.name != DELIVERY]), folder)
            every = store._read(folder, schema)
            own = every.filter(F.col(DELIVERY) == delivery).select(dim.key)
            lost = every.join(replaced, [SLICE, DELIVERY], "left_semi").select(dim.key)
            touched = own.unionByName(lost).distinct().withColumnRenamed(dim.key, "_key")
            touched = written(touched, "touched-keys")
            same = F.col(dim.key).eqNullSafe(F.col("_key"))
            live = every.join(after, [SLICE, DELIVERY], "left_semi").join(touched, same, "left_semi")
            winners = _collapsed(live, dim, store.rule, by_slice=False).withColumn(GONE, F.lit(False))
            found = touched.join(winners, same, "left").withColumn(GONE, F.coalesce(GONE, F.lit(True)))
            found = found.drop(dim.key).withColumnRenamed("_key", dim.key)
            put(found.select(*model.table_schema(dim.table).fieldNames(), GONE), f"{WINNERS}/{dim.table}")

        together(spark, write_parents, write_facts, write_dimensions)
        put(judged.select(SLICE, "outcome"), OUTCOMES)
        # The log comes last.
        put(taken.select(SLICE, "content", "n_entries"), LOG)


def entry_count_mismatch(store: CorrectableStore) -> DataFrame:
    """Empty if the fact table holds exactly the entries that the standing versions reported."""
    tbl = F.lit(store.model.fact_table).alias("tbl")
    reported = store.log().join(store.standing(), [SLICE, DELIVERY], "left_semi")
    reported = reported.agg(F.coalesce(F.sum("n_entries"), F.lit(0)).alias("n")).select(tbl, "n")
    actual = store.facts(store.model.fact_table).agg(F.count("*").alias("n")).select(tbl, "n")
    return mismatches(reported, actual)


def publish(store: CorrectableStore, target: str) -> dict[str, DataFrame]:
    """A copy of the store's tables without replaced versions, as plain tables under ``target``."""
    with stages(store.spark):
        write_tables(store.tables(), target, store.model)
    return read_tables(store.spark, target, store.model)
