"""Functional dependencies found by a level-wise search, not only checked one at a time."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from flatloom.scratch import stages, written

_SCHEMA = StructType([StructField("determinant", ArrayType(StringType())), StructField("dependent", StringType())])
Columns = frozenset[str]


class _Counts:
    """How many distinct combinations sets of columns have; each set is counted once.

    The rows are the distinct combinations of all columns. NULL is a value like any other. A set has as many
    combinations as it has with all columns that it determines, so of the sets that determine the same
    columns, as far as counts have shown, one is counted.
    """

    def __init__(self, rows: DataFrame):
        self._rows, self._known = rows, {frozenset(): min(1, rows.limit(1).count())}
        # Sets with a larger one that has as many combinations.
        self._equal: list[tuple[Columns, Columns]] = []

    def _closure(self, columns: Columns) -> Columns:
        """The columns with all that they are known to determine."""
        closed, before = columns, None
        while closed != before:
            before = closed
            for x, y in self._equal:
                closed = closed | y if x <= closed else closed
        return closed

    def _count(self, columns: Columns) -> int:
        """One set per job: only its columns are hashed and shuffled, and each row once."""
        if columns == frozenset(self._rows.columns):
            return self._rows.count()
        return self._rows.select(*(F.col(f"`{c}`") for c in sorted(columns))).distinct().count()

    def _add(self, columns: Columns) -> None:
        closed = self._closure(columns)
        n = next((n for x, n in self._known.items() if self._closure(x) == closed), None)
        # Columns that the others of the set determine need not be read.
        least = columns
        for c in sorted(columns):
            least = least - {c} if c in self._closure(least - {c}) else least
        n = self._count(least) if n is None else n
        for x, known in self._known.items():
            if known == n and (x < columns or columns < x):
                self._equal.append((x, columns) if x < columns else (columns, x))
        self._known[columns] = n

    def ensure(self, sets: Iterable[Columns]) -> None:
        missing = {s for s in sets if s not in self._known}
        for size in sorted({len(s) for s in missing}):
            # The smallest first: what they show saves counting larger ones.
            some = [s for s in missing if len(s) == size]
            for s in sorted(some, key=lambda s: (prod(self._known.get(frozenset({c}), 1) for c in s), sorted(s))):
                self._add(s)

    def __getitem__(self, columns: Columns) -> int:
        return self._known[columns]


def minimal_dependencies(rows: DataFrame, columns: Sequence[str], max_determinant: int = 3) -> list[tuple[Columns, str]]:
    """The dependencies X -> a with at most ``max_determinant`` columns in X of which none can be left out.

    X determines a if adding a splits no combination of X: both have as many distinct
    combinations. Sets are searched by size, from constants (an empty X) up. Left out without being
    counted: pairs whose dependent a smaller determinant settles, and sets that hold a key or a column that
    others of the set determine, which cannot be minimal.
    """
    distinct = written(rows.select(*(F.col(f"`{c}`") for c in columns)).distinct(), "distinct-rows")
    counts, everything = _Counts(distinct), frozenset(columns)
    counts.ensure([everything])
    total = counts[everything]
    found: list[tuple[Columns, str]] = []
    # Sets that may still be a part of a minimal determinant.
    level: list[Columns] = [frozenset()]
    for size in range(min(max_determinant, len(columns) - 1) + 1):
        known = {a: [x for x, dependent in found if dependent == a] for a in columns}
        open_pairs = [(x, a) for x in level for a in columns if a not in x and not any(smaller <= x for smaller in known[a])]
        counts.ensure({x for x, _ in open_pairs} | {x | {a} for x, a in open_pairs})
        found += [(x, a) for x, a in open_pairs if counts[x] == counts[x | {a}]]
        # A key determines all else, so nothing that holds it is minimal; nor is a set with a column
        # that the rest of it determines.
        counts.ensure(level)
        keys = [x for x in level if counts[x] == total]
        survivors = [x for x in level if x not in keys]
        grown = {x | {a} for x in survivors for a in columns if a not in x}
        alive = set(survivors)
        level = [
            x for x in sorted(grown, key=sorted)
            if len(x) == size + 1
            and all(x - {a} in alive for a in x)
            and not any(dependent in x and left <= x - {dependent} for left, dependent in found)
        ]
        if not level:
            break
    return found


def discovered_dependencies(rows: DataFrame, columns: Sequence[str], max_determinant: int = 3) -> DataFrame:
    """(determinant, dependent), the minimal dependencies between the columns as they hold in the rows.

    The rows shrink to their distinct combinations first, and every count has a partial step. Sets that dependencies
    already found make equal are counted once. What the driver holds are numbers, one per set of columns; their number depends on the columns alone.
    No rows make every column a constant.
    """
    spark = rows.sparkSession
    with stages(spark):
        found = minimal_dependencies(rows, columns, max_determinant)
    return spark.createDataFrame([(sorted(x), a) for x, a in sorted(found, key=lambda f: (sorted(f[0]), f[1]))], _SCHEMA)


def candidate_keys(rows: DataFrame, columns: Sequence[str], max_size: int = 3) -> list[list[str]]:
    """The smallest sets of at most ``max_size`` columns whose values differ in every distinct row."""
    with stages(rows.sparkSession):
        distinct = written(rows.select(*(F.col(f"`{c}`") for c in columns)).distinct(), "distinct-rows")
        counts, everything = _Counts(distinct), frozenset(columns)
        counts.ensure([everything])
        keys: list[Columns] = []
        for size in range(1, min(max_size, len(columns)) + 1):
            some = [frozenset(x) for x in combinations(columns, size)]
            some = [x for x in some if not any(k <= x for k in keys)]
            counts.ensure(some)
            keys += [x for x in some if counts[x] == counts[everything]]
    return [sorted(k) for k in keys]
