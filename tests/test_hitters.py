"""The most repeated keys, and how few keys are counted for them."""

import random

import pytest
from documents import rows
from pyspark.sql import functions as F

from flatloom.operators.counts import hottest_keys
from flatloom.operators.hitters import candidate_buckets, heavy_hitters


@pytest.fixture(scope="module")
def skewed(spark):
    """Some hot keys, NULL among them, and a long tail."""
    hot = [(k, n) for k, n in ((1, 900), (2, 500), (None, 400), (3, 400), (4, 90)) for _ in range(n)]
    return spark.createDataFrame([(k,) for k, _ in hot] + [(10_000 + i,) for i in range(4000)], "key long").repartition(5)


def test_skewed_keys(spark, skewed):
    for k in (1, 3, 4, 5):
        assert rows(heavy_hitters(skewed, "key", k)) == rows(hottest_keys(skewed, "key", k))
    chosen = candidate_buckets(skewed, "key", 4)
    assert chosen.count() <= 8
    # More than there are frequent keys: every bucket may hold one.
    assert rows(heavy_hitters(skewed, "key", 7)) == rows(hottest_keys(skewed, "key", 7))


@pytest.mark.parametrize("buckets", [1, 8, 1 << 16])
def test_flat_keys_and_few_buckets(spark, buckets):
    draw = random.Random(2)
    df = spark.createDataFrame([(draw.randrange(300), draw.choice("ab")) for _ in range(2000)], "a long, b string")
    assert rows(heavy_hitters(df, ["a", "b"], 10, buckets)) == rows(hottest_keys(df, ["a", "b"], 10))


def test_fewer_keys_than_asked_for(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "key string")
    assert rows(heavy_hitters(df, "key", 10)) == [("x", 2), (None, 1)]
    assert rows(heavy_hitters(df.limit(0), "key", 10)) == []
    assert heavy_hitters(df.withColumn("n", F.lit(1)), "key", 1).columns == ["key", "n"]
