"""Lookups by a table of keys, and the files that they leave alone."""

from pathlib import Path

import pytest
from documents import rows
from pyspark.sql import functions as F

from flatloom.operators import lookup
from flatloom.operators.lookup import BUCKET, facts_of_keys, parents_of_keys, write_by_key


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """A third of the facts under one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500))
    facts = spark.range(6000).select(F.col("id").alias("pid"), F.lit(0).alias("pos"), key.alias("track"))
    facts = facts.unionByName(facts.limit(3).withColumn("track", F.lit(None).cast("string")))
    path = str(tmp_path_factory.mktemp("lookup") / "facts")
    write_by_key(facts, path, "track", "pid", buckets=32)
    return path, facts


def of_keys(spark, laid_out, keys):
    path, facts = laid_out
    table = spark.createDataFrame([(k,) for k in keys], "k string")
    return facts_of_keys(spark, path, facts.schema, table, "track", 32)


@pytest.mark.parametrize("pushed", [200, 0])
def test_keys_of_all_kinds(spark, laid_out, monkeypatch, pushed):
    monkeypatch.setattr(lookup, "PUSHED_KEYS", pushed)
    facts = laid_out[1]
    for keys in ([], ["none"], ["t7", "t7", None], ["hot", "t1", "t2"], [None]):
        expected = facts.filter(F.col("track").isin([k for k in keys if k])) if any(keys) else facts.limit(0)
        assert rows(of_keys(spark, laid_out, keys)) == rows(expected)
    table = spark.createDataFrame([("t7",), ("t8",)], "k string")
    found = parents_of_keys(spark, laid_out[0], facts.schema, table, "track", "pid", 32)
    assert rows(found) == rows(facts.filter("track in ('t7', 't8')").select("track", "pid").distinct())


@pytest.mark.parametrize("pushed", [200, 0])
def test_other_buckets_are_not_opened(spark, laid_out, monkeypatch, tmp_path, pushed):
    """A copy in which all files but those of the key's bucket are spoiled."""
    monkeypatch.setattr(lookup, "PUSHED_KEYS", pushed)
    path = str(tmp_path / "facts")
    write_by_key(laid_out[1], path, "track", "pid", buckets=32)
    wanted = spark.read.parquet(path).filter("track = 't7'").select(BUCKET).first()[0]
    for folder in Path(path).glob(f"{BUCKET}=*"):
        if folder.name != f"{BUCKET}={wanted}":
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"spoiled")
                (folder / f".{file.name}.crc").unlink(missing_ok=True)
    assert of_keys(spark, (path, laid_out[1]), ["t7"]).count() == 12 - 4


def test_a_few_keys_reach_the_scan(spark, laid_out):
    plan = of_keys(spark, laid_out, ["t7", "t8"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(track, [t7,t8])]" in plan
    assert "PartitionFilters: [key_bucket" in plan
