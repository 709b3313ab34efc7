"""Reading nested documents with an explicit schema, loudly or with a quarantine."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flatloom.schemas import DocumentModel
from flatloom.scratch import written
from flatloom.sources.slices import SLICE_GLOB

SOURCE = "source_file"
CORRUPT = "_corrupt_record"
# One document per slice file, one document per line, or nested columns already in Parquet.
LAYOUTS = ("file", "lines", "parquet")


def _loaded(reader, paths: str | list[str], schema: StructType, layout: str, mode: str) -> DataFrame:
    """Documents with the file they came from; files are read as text and parsed by the caller."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    reader = reader.option("recursiveFileLookup", "true")
    if layout == "file":
        loaded = reader.format("text").option("wholetext", "true").option("pathGlobFilter", SLICE_GLOB).load(paths)
    elif layout == "lines":
        loaded = reader.schema(schema).format("json").option("mode", mode).load(paths)
    else:
        loaded = reader.schema(schema).format("parquet").load(paths)
    return loaded.withColumn(SOURCE, F.col("_metadata.file_path"))


def _is_one_document(text: Column) -> Column:
    """Whether a text is a single JSON value: as the only element of an array it counts as one.

    Two values without a comma between them, or anything after the first, make the array
    invalid, whatever the documents contain.
    """
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))


def _parsed_or_failed(files: DataFrame, schema: StructType) -> DataFrame:
    """One document per file; a file that holds anything else fails the job."""
    complaint = F.concat(F.lit("not exactly one JSON document: "), F.col(SOURCE))
    one = F.when(_is_one_document(F.col("value")), F.col("value")).otherwise(F.raise_error(complaint))
    parsed = F.from_json(one, schema, {"mode": "FAILFAST"})
    return files.select(parsed.alias("_doc"), SOURCE).select("_doc.*", SOURCE)


def read_documents(
    spark: SparkSession,
    paths: str | list[str],
    model: DocumentModel,
    layout: str = "file",
    parent_fields: Iterable[str] | None = None,
    entry_fields: Iterable[str] | None = (),
) -> DataFrame:
    """One row per document, with the file it came from; a malformed document fails the job.

    With the layout "file" only slice files are read, and a file must hold one document: two of
    them, trailing text or white space alone fail as well. A file of no bytes is no input to
    Spark and gives no row. ``parent_fields`` and ``entry_fields``
    narrow what is converted. Leave both out to read everything; ``entry_fields=None`` skips
    the entry arrays.
    """
    schema = model.schema
    if parent_fields is not None:
        schema = model.pruned(parent_fields, entry_fields)
    loaded = _loaded(spark.read, paths, schema, layout, "FAILFAST")
    return _parsed_or_failed(loaded, schema) if layout == "file" else loaded


def stream_documents(
    spark: SparkSession,
    root: str,
    model: DocumentModel,
    layout: str = "file",
    files_per_batch: int | None = 100,
    bytes_per_batch: int | None = None,
    only: Column | None = None,
) -> DataFrame:
    """The same as a file stream, in batches of ``files_per_batch`` files or ``bytes_per_batch``.

    Batches by bytes keep their number in proportion to the data where files are small. ``only``
    is a condition on the source column; the other files are not parsed.
    """
    if bytes_per_batch is not None:
        reader = spark.readStream.option("maxBytesPerTrigger", bytes_per_batch)
    else:
        reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    loaded = _loaded(reader, root, model.schema, layout, "FAILFAST")
    if only is not None:
        loaded = loaded.filter(only)
    return _parsed_or_failed(loaded, model.schema) if layout == "file" else loaded


@dataclass(frozen=True)
class Quarantine:
    """Documents that parsed, and the raw text of those that did not."""

    good: DataFrame
    rejects: DataFrame


def quarantined(files: DataFrame, model: DocumentModel) -> DataFrame:
    """Documents of (value, source_file) rows with their raw text in ``_corrupt_record`` if rejected.

    A text is rejected if it does not parse or holds anything but one document.
    """
    schema = StructType([*model.schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = files.select(F.from_json("value", schema, options).alias("_doc"), "value", SOURCE)
    bad = ~_is_one_document(F.col("value")) | F.col(f"_doc.{CORRUPT}").isNotNull()
    fields = [F.when(~bad, F.col("_doc")[f.name]).alias(f.name) for f in model.schema]
    return parsed.select(*fields, F.when(bad, F.col("value")).alias(CORRUPT), SOURCE)


def read_with_quarantine(
    spark: SparkSession, paths: str | list[str], model: DocumentModel, layout: str = "file"
) -> Quarantine:
    """Split malformed documents off instead of failing: nothing is lost without a trace."""
    schema = StructType([*model.schema.fields, StructField(CORRUPT, StringType())])
    reader = spark.read
    if layout == "lines":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    loaded = _loaded(reader, paths, schema, layout, "PERMISSIVE")
    # Written once: both outputs come from one parse, and a text reader cannot be asked
    # for the corrupt record alone.
    docs = written(quarantined(loaded, model) if layout == "file" else loaded, "quarantine")
    return Quarantine(
        good=docs.filter(F.col(CORRUPT).isNull()).drop(CORRUPT),
        rejects=docs.filter(F.col(CORRUPT).isNotNull()).select(SOURCE, F.col(CORRUPT).alias("text")),
    )


def documents_from_text(texts: DataFrame, model: DocumentModel, column: str = "value") -> DataFrame:
    """Documents held as text in a column, such as whole files read as text."""
    parsed = F.from_json(F.col(column), model.schema, {"mode": "FAILFAST"})
    kept = [c for c in texts.columns if c != column]
    return texts.select(*kept, parsed.alias("_doc")).select(*kept, "_doc.*")
