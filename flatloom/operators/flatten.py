"""From documents to parent rows, wide entries and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatloom.functions import epoch_to_timestamp, text_flag
from flatloom.schemas import DocumentModel
from flatloom.sources.documents import SOURCE

PARENT_ORD = "parent_ord"
ENTRY_ORD = "entry_ord"


def explode_parents(
    docs: DataFrame, model: DocumentModel, ordinals: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per parent object, next to the file it came from. ``keep`` names bookkeeping columns that stay."""
    kept = [c for c in docs.columns if c == SOURCE or c in keep]
    if not ordinals:
        return docs.select(*kept, F.explode(model.parents).alias("_p")).select(*kept, "_p.*")
    numbered = docs.select(*kept, F.posexplode(model.parents).alias(PARENT_ORD, "_p"))
    return numbered.select(*kept, PARENT_ORD, "_p.*")


def parent_rows(parents: DataFrame, model: DocumentModel, keep: Sequence[str] = ()) -> DataFrame:
    """The parent table: typed scalars, one row per parent, also for parents without entries.

    ``keep`` names bookkeeping columns that stay.
    """
    if model.part and model.part in parents.columns:
        parents = parents.filter(F.coalesce(F.col(model.part), F.lit(0)) == 0)

    def typed(name: str):
        if name in model.flags:
            return text_flag(F.col(name)).alias(name)
        if name in model.epochs:
            return epoch_to_timestamp(F.col(name)).alias(name)
        return F.col(name)

    return parents.select(*[typed(c) for c in model.parent_columns if c in parents.columns], *keep)


def entry_rows(
    parents: DataFrame, model: DocumentModel, ordinals: bool = False, outer: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Wide entries: the parent key and every field of the entry.

    A parent with an empty or missing array yields no row, or with ``outer`` one row
    of NULLs. ``ordinals`` adds the places in both arrays, which order the writes.
    ``keep`` names bookkeeping columns that stay.
    """
    kept = [c for c in (SOURCE, PARENT_ORD, *keep) if c in parents.columns]
    keys = [*kept, model.parent_key]
    if ordinals:
        explode = F.posexplode_outer if outer else F.posexplode
        rows = parents.select(*keys, explode(model.entries).alias(ENTRY_ORD, "_e"))
        return rows.select(*keys, ENTRY_ORD, "_e.*")
    explode = F.explode_outer if outer else F.explode
    return parents.select(*keys, explode(model.entries).alias("_e")).select(*keys, "_e.*")


def wide_entries(docs: DataFrame, model: DocumentModel) -> DataFrame:
    """Documents straight to wide entries, without bookkeeping columns."""
    rows = entry_rows(explode_parents(docs, model), model)
    return rows.drop(SOURCE)


def fact_rows(entries: DataFrame, model: DocumentModel) -> DataFrame:
    """The fact table: which entry stands at which place of which parent."""
    return entries.select(*model.fact_columns)


def parents_without_entries(parents: DataFrame, model: DocumentModel) -> DataFrame:
    """Keys of parents whose array is empty or missing."""
    heads = parents
    if model.part and model.part in parents.columns:
        heads = heads.filter(F.coalesce(F.col(model.part), F.lit(0)) == 0)
    empty = F.coalesce(F.size(model.entries), F.lit(0)) <= 0
    return heads.filter(empty).select(model.parent_key)


def entries_per_parent(parents: DataFrame, model: DocumentModel) -> DataFrame:
    """Number of entries of every parent, counted over all its parts without exploding."""
    n = F.greatest(F.coalesce(F.size(model.entries), F.lit(0)), F.lit(0)).cast("long")
    return parents.groupBy(model.parent_key).agg(F.sum(n).alias("n_entries"))
