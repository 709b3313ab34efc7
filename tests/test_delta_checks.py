"""Checks of a batch against what is stored, compared with checks of everything."""

import random
from pathlib import Path

import pytest

from flatloom.operators.checks import key_violations, not_null_violations, orphan_keys
from flatloom.plans.delta_checks import BatchChecks, Rules, key_findings
from flatloom.schemas import Reference

RULES = Rules({"facts": ("pid", "pos"), "tracks": ("track",)}, (Reference("facts", "track", "tracks", "track"),), {"facts": ("pid", "name")})
FACTS = "pid long, pos int, track long, name string"


def whole(tables):
    found = {}
    for t, key in RULES.keys.items():
        found["primary_key", f"{t}({', '.join(key)})"] = key_violations(tables[t], key).count()
    n = orphan_keys(tables["facts"], "track", tables["tracks"], "track").agg({"n": "sum"}).first()[0]
    found["foreign_key", "facts.track -> tracks"] = n or 0
    for r in not_null_violations(tables["facts"], ["pid", "name"]).collect():
        found["not_null", f"facts.{r.col}"] = r.violations
    return found


def random_batches():
    draw = random.Random(3)
    for size in (40, 1, 0, 60):
        facts = [
            (draw.choice([None, *range(6)]), draw.choice([None, 0, 1, 2]), draw.choice([None, *range(12)]), draw.choice([None, "n"]))
            for _ in range(size)
        ]
        yield facts, [(draw.randrange(14),) for _ in range(size // 10 + 1)]


def test_equal_to_the_whole_check_after_every_batch(spark, tmp_path):
    checks = BatchChecks(spark, str(tmp_path), RULES)
    seen = {"facts": [], "tracks": []}
    for batch, (facts, tracks) in enumerate(random_batches()):
        frame = lambda rows, table: spark.createDataFrame(rows, FACTS if table == "facts" else "track long")
        old = {t: frame(rows, t) for t, rows in seen.items()}
        new = {"facts": frame(facts, "facts"), "tracks": frame(tracks, "tracks")}
        seen = {"facts": seen["facts"] + facts, "tracks": seen["tracks"] + tracks}
        expected = whole({t: frame(rows, t) for t, rows in seen.items()})
        for _ in range(2 if batch == 1 else 1):  # run again: the same findings
            found = {(r.kind, r.target): r.violations for r in checks.check(batch, new, old).collect()}
            assert found == expected


@pytest.mark.parametrize("parents", [[(5,)], []])
def test_children_wait_for_parents(spark, tmp_path, parents):
    checks = BatchChecks(spark, str(tmp_path), Rules({}, RULES.references))
    none = {"facts": spark.createDataFrame([], FACTS), "tracks": spark.createDataFrame([], "track long")}
    first = none | {"facts": spark.createDataFrame([(1, 0, 5, "a"), (1, 1, 5, "a"), (1, 2, 6, "a"), (1, 3, None, "a")], FACTS)}
    checks.check(0, first, none)
    assert sorted(map(tuple, checks.findings("reference-facts-track", 0).collect())) == [(5, 2), (6, 1)]
    checks.check(1, none | {"tracks": spark.createDataFrame(parents, "track long")}, first)
    left = [(6, 1)] if parents else [(5, 2), (6, 1)]
    assert sorted(map(tuple, checks.findings("reference-facts-track", 1).collect())) == left


def test_stored_rows_are_read_by_their_keys_only(spark, tmp_path):
    stored = str(tmp_path / "stored")
    spark.createDataFrame([(1, 0, 5, "a")], FACTS).write.parquet(stored)
    new = spark.createDataFrame([(1, 0, 6, "b"), (2, 0, 6, "b")], FACTS)
    found = key_findings(new, spark.read.parquet(stored), ["pid", "pos"], spark.createDataFrame([], "pid long, pos int, n long"))
    assert [tuple(r) for r in found.collect()] == [(1, 0, 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if Path(stored).name in line and "ReadSchema" in line]
    assert scans and all("ReadSchema: struct<pid:bigint,pos:int>" in line for line in scans)
