"""Collapsing repeated keys: six rules for which row, or which values, win.

Every rule is an aggregate with a partial step before the shuffle, so a key that holds
a third of all rows arrives as one row per input partition. None of them uses a window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatloom.schemas import Dimension
from flatloom.scratch import written

# So many keys are a small side of a join.
FEW_KEYS = 100_000


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _extreme_row(
    rows: DataFrame, pick: Callable[[Column], Column], key: list[str], attrs: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The attributes of the smallest or largest row by ``order_by``, then by the attributes.

    One struct holds the order and the attributes, so a single value per key is compared,
    kept and shuffled.
    """
    fields = [*order_by, *[a for a in attrs if a not in order_by]]
    winner = pick(F.struct(*fields)).alias("_row")
    return rows.groupBy(*key).agg(winner).select(*key, *[F.col("_row")[a].alias(a) for a in attrs])


def min_per_column(
    rows: DataFrame, key: str | Sequence[str], attrs: Sequence[str], distinct_first: bool = False
) -> DataFrame:
    """The smallest value of each attribute; the values may come from different rows.

    Minima of text are found by sorting. ``distinct_first`` lets a hash aggregate remove
    the copies before that: better for dimensions, whose rows repeat many times over.
    """
    if distinct_first:
        # A plain distinct is optimized away below minima, and all rows would be sorted; a condition on its groups keeps it.
        once = rows.groupBy(*_names(key), *attrs).agg(F.count("*").alias("_copies"))
        rows = once.filter(F.col("_copies") > 0).drop("_copies")
    return rows.groupBy(*_names(key)).agg(*[F.min(a).alias(a) for a in attrs])


def smallest_row(rows: DataFrame, key: str | Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """One whole row per key, always the same one: the smallest by its attributes."""
    return _extreme_row(rows, F.min, _names(key), attrs, [])


def any_row(rows: DataFrame, key: str | Sequence[str], attrs: Sequence[str], deterministic: bool = True) -> DataFrame:
    """One whole row per key. Without ``deterministic`` it may be another one in each run."""
    if deterministic:
        return smallest_row(rows, key, attrs)
    return rows.select(*_names(key), *attrs).dropDuplicates(_names(key))


def last_write_wins(
    rows: DataFrame, key: str | Sequence[str], attrs: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The whole row written last; put the slice into ``key`` to collapse within slices only."""
    return _extreme_row(rows, F.max, _names(key), attrs, order_by)


def first_row(
    rows: DataFrame, key: str | Sequence[str], attrs: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The whole row that comes first in the given order."""
    return _extreme_row(rows, F.min, _names(key), attrs, order_by)


def first_slice_wins(
    rows: DataFrame,
    key: str | Sequence[str],
    attrs: Sequence[str],
    slice_column: str,
    order_by: Sequence[str],
) -> DataFrame:
    """What slices inserted one by one leave behind when an existing key is never changed.

    Within a slice the last write stands, then the earliest slice keeps the key: the last row
    by the slice counted backwards, then by the order. The slice is a number. A row without a
    slice loses against any other, one without a place against any other of its slice.
    """
    names = _names(key)
    back = rows.withColumn("_back", -F.col(slice_column).cast("decimal(20,0)"))
    # The earliest slices are found by hashing. Rows are sorted to find the last of a key, so only those of its
    # earliest slice go on, as long as the keys are few enough to be sent to all tasks.
    first = back.groupBy(*names).agg(F.max("_back").alias("_first"))
    first = written(first.select(*[F.col(n).alias(f"_key{i}") for i, n in enumerate(names)], "_first"), "first-slices")
    if first.count() > FEW_KEYS:
        return last_write_wins(back, key, attrs, ["_back", *order_by])
    same = F.col("_back").eqNullSafe(F.col("_first"))
    for i, n in enumerate(names):
        same &= F.col(n).eqNullSafe(F.col(f"_key{i}"))
    return last_write_wins(back.join(first, same, "left_semi"), key, attrs, order_by)


def new_keys(incoming: DataFrame, known: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that have not been emitted before, once each.

    Both sides shrink to their distinct keys before they meet.
    """
    names = _names(key)
    return incoming.select(*names).distinct().join(known.select(*names).distinct(), names, "left_anti")


def new_rows(incoming: DataFrame, known: DataFrame, key: str | Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Insert-ignore against a stored table: one row per key that the table lacks."""
    names = _names(key)
    return smallest_row(incoming, names, attrs).join(known.select(*names).distinct(), names, "left_anti")


RULES = ("min", "smallest", "any", "last", "first")


def dimension_table(
    entries: DataFrame,
    dim: Dimension,
    rule: str = "min",
    order_by: Sequence[str] = (),
    distinct_first: bool = True,
) -> DataFrame:
    """A dimension of the model from wide entries, under the chosen rule.

    Pass ``distinct_first=False`` for rows that are nearly distinct already.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")
    columns = [F.col(dim.key)] + [F.col(src).alias(out) for out, src in dim.attributes.items() if out != dim.key]
    attrs = [out for out in dim.attributes if out != dim.key]
    extra = [c for c in order_by if c not in {dim.key, *attrs}]
    rows = entries.select(*columns, *extra)
    if rule == "min":
        return min_per_column(rows, dim.key, attrs, distinct_first)
    if rule == "smallest":
        return smallest_row(rows, dim.key, attrs)
    if rule == "any":
        return any_row(rows, dim.key, attrs, deterministic=False)
    if not order_by:
        raise ValueError(f"rule {rule!r} needs order_by")
    collapse = last_write_wins if rule == "last" else first_row
    return collapse(rows, dim.key, attrs, order_by)
