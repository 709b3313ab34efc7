"""Fields that documents have and the model does not name, found in one pass with VARIANT."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatloom.schemas import DocumentModel

_FIELDS = "map<string,variant>"
_FOUND = "array<struct<path: string, type: string>>"
# Reported as the type of a text that is no JSON.
MALFORMED = "MALFORMED"


def _report(path: str, value: Column) -> Column:
    """One finding: a value that should not be there, with its type down to the last field."""
    return F.struct(F.lit(path).alias("path"), F.schema_of_variant(value).alias("type"))


def _fields(value: Column) -> Column:
    """The fields of an object; NULL for anything else."""
    return F.try_variant_get(value, "$", _FIELDS)


def _elements(value: Column) -> Column:
    """The elements of an array; NULL for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def _undeclared(value: Column, path: str, declared: Iterable[str]) -> Column:
    """Findings in one object: fields that are not declared, or the value itself if it is no object."""
    names = list(declared)
    extra = F.map_filter(_fields(value), lambda k, _: ~k.isin(names)) if names else _fields(value)
    found = F.transform(
        F.map_entries(extra),
        lambda e: F.struct(F.concat(F.lit(f"{path}."), e["key"]).alias("path"), F.schema_of_variant(e["value"]).alias("type")),
    )
    # JSON null is a missing object.
    odd = F.when(F.is_variant_null(value), F.array().cast(_FOUND)).otherwise(F.array(_report(path, value)).cast(_FOUND))
    return F.when(value.isNull(), F.array().cast(_FOUND)).when(_fields(value).isNull(), odd).otherwise(found.cast(_FOUND))


def _in_array(value: Column, path: str, each) -> Column:
    """Findings in the elements of an array, or the value itself if it is there and no array."""
    odd = F.when(F.is_variant_null(value), F.array().cast(_FOUND)).otherwise(F.array(_report(path, value)).cast(_FOUND))
    inside = F.flatten(F.transform(_elements(value), each))
    return F.when(value.isNull(), F.array().cast(_FOUND)).when(_elements(value).isNull(), odd).otherwise(inside)


def _counted(texts: DataFrame, findings) -> DataFrame:
    # Parsed in a projection of its own, so that the findings share one parse.
    parsed = texts.select(F.try_parse_json("_text").alias("_v"), "_text")
    malformed = F.array(F.struct(F.lit("$").alias("path"), F.lit(MALFORMED).alias("type"))).cast(_FOUND)
    all_found = F.when(F.col("_v").isNull() & F.col("_text").isNotNull(), malformed).otherwise(findings(F.col("_v")))
    rows = parsed.select(F.explode(all_found).alias("_f")).select("_f.*")
    return rows.groupBy("path", "type").agg(F.count("*").alias("n"))


def undeclared_fields(texts: DataFrame, column: str, declared: Iterable[str] = ()) -> DataFrame:
    """(path, type, n) of the fields in flat JSON objects that are not declared.

    ``type`` is the type of the value, nested fields included, so a field that comes with two types
    has two rows. A text that is no JSON is reported as ``$`` with the type MALFORMED, one that is
    no object with its type; NULL has no fields.
    """
    named = list(declared)
    return _counted(texts.select(F.col(column).alias("_text")), lambda v: _undeclared(v, "$", named))


def undeclared_document_fields(texts: DataFrame, column: str, model: DocumentModel) -> DataFrame:
    """The same for whole documents: in the document, in its parents and in their entries.

    A reader with a schema passes over what the schema does not name. Here each text is parsed
    once as a VARIANT and its fields are held against the model, without a second pass
    for inference. Parents or entries that are no arrays of objects are reported as they are.
    """
    parents, entries = f"$.{model.parents}[*]", f"$.{model.parents}[*].{model.entries}[*]"
    in_parent, in_entry = model.parent_schema.fieldNames(), model.entry_schema.fieldNames()

    def entry(value: Column) -> Column:
        return _undeclared(value, entries, in_entry)

    def parent(value: Column) -> Column:
        own = F.try_element_at(_fields(value), F.lit(model.entries))
        return F.concat(_undeclared(value, parents, in_parent), _in_array(own, entries.removesuffix("[*]"), entry))

    def document(value: Column) -> Column:
        own = F.try_element_at(_fields(value), F.lit(model.parents))
        return F.concat(_undeclared(value, "$", [model.parents]), _in_array(own, f"$.{model.parents}", parent))

    return _counted(texts.select(F.col(column).alias("_text")), document)
