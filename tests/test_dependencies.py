"""Dependencies found in tables, against every set of columns tried in turn."""

import random
from itertools import combinations

import pytest

from flatloom.operators import dependencies
from flatloom.operators.dependencies import candidate_keys, discovered_dependencies

COLUMNS = ("a", "b", "c", "d")
SCHEMA = "a int, b string, c int, d double"


def brute(rows, size):
    places = {c: i for i, c in enumerate(COLUMNS)}

    def holds(x, a):
        return len({tuple(r[places[c]] for c in x) for r in rows}) == len({tuple(r[places[c]] for c in (*x, a)) for r in rows})

    every = [(set(x), a) for n in range(size + 1) for x in combinations(COLUMNS, n) for a in COLUMNS if a not in x and holds(x, a)]
    return {(tuple(sorted(x)), a) for x, a in every if not any(y < x and b == a for y, b in every)}


def found(spark, rows, size=3):
    df = discovered_dependencies(spark.createDataFrame(rows, SCHEMA), COLUMNS, size)
    return {(tuple(r.determinant), r.dependent) for r in df.collect()}


@pytest.mark.parametrize("seed", range(5))
def test_random_tables(spark, seed):
    draw = random.Random(seed)
    wide = draw.choice([2, 3, 6])
    rows = []
    for _ in range(draw.choice([4, 12, 40])):
        a, c = draw.choice([None, *range(wide)]), draw.randrange(2)
        rows.append((a, None if a is None else f"of {a % 2}", c, float(draw.randrange(wide)) if seed % 2 else float((a or 0) + 10 * c)))
    assert found(spark, rows) == brute(rows, 3)
    assert found(spark, rows, 1) == brute(rows, 1)


def test_constants_keys_copies_and_nulls(spark):
    rows = [(1, "x", 7, None), (1, "x", 7, None), (2, None, 7, None), (3, None, 7, 0.0)]
    assert found(spark, rows) == brute(rows, 3)
    assert ((), "c") in found(spark, rows)
    assert candidate_keys(spark.createDataFrame(rows, SCHEMA), COLUMNS) == [["a"], ["b", "d"]]


def test_no_rows(spark):
    assert found(spark, []) == {((), c) for c in COLUMNS}


def test_pruned_sets_are_not_counted(spark, monkeypatch):
    """A key of one column leaves nothing to count above it."""
    counted = []
    ensure = dependencies._Counts.ensure
    monkeypatch.setattr(dependencies._Counts, "ensure", lambda self, sets: (counted.extend(sets := list(sets)), ensure(self, sets))[1])
    rows = [(i, f"b{i}", i, float(i)) for i in range(9)]
    assert found(spark, rows) == brute(rows, 3)
    assert max(len(s) for s in counted if len(s) < len(COLUMNS)) == 2


def test_sets_that_determine_the_same_columns_are_counted_once(spark, monkeypatch):
    """Of two columns that determine each other, sets with one of them are counted, each in a job of its own columns."""
    counted = []
    count = dependencies._Counts._count
    monkeypatch.setattr(dependencies._Counts, "_count", lambda self, columns: (counted.append(set(columns)), count(self, columns))[1])
    rows = [(i % 5, f"b{i % 5}", i % 31, float(i * i % 37)) for i in range(100)]
    assert found(spark, rows) == brute(rows, 3)
    assert not [s for s in counted if {"a", "b"} < s and s != set(COLUMNS)]
    assert not [s for s in counted if "a" in s and len(s) > 1 and s - {"a"} | {"b"} in counted and s != {"a", "b"}]
