"""The most repeated keys without shuffling all keys: counts of hash buckets bound the counts of their keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatloom.scratch import written

# Buckets that the keys are hashed to; their counts are the only thing that every key contributes to.
BUCKETS = 1 << 16


def _bucket(names: Sequence[str], buckets: int) -> Column:
    # Hashing passes over NULL, so that is hashed as a column of its own.
    parts = [part for c in names for part in (F.col(c).isNull(), F.col(c))]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets))


def bucket_counts(entries: DataFrame, key: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): a mergeable sketch; no key of a bucket comes more often than ``n`` times.

    At most ``buckets`` rows leave a task, however many keys it has seen.
    """
    names = [key] if isinstance(key, str) else list(key)
    return entries.groupBy(_bucket(names, buckets).alias("bucket")).agg(F.count("*").alias("n"))


def _counted_in(entries: DataFrame, names: Sequence[str], chosen: DataFrame, buckets: int) -> DataFrame:
    """(key, n) of the keys of some buckets."""
    placed = entries.select(*names, _bucket(names, buckets).alias("_bucket"))
    inside = placed.join(chosen.select(F.col("bucket").alias("_bucket")), "_bucket", "left_semi")
    return inside.groupBy(*names).agg(F.count("*").alias("n"))


def candidate_buckets(entries: DataFrame, key: str | Sequence[str], k: int, buckets: int = BUCKETS) -> DataFrame:
    """The buckets that can hold one of the ``k`` most repeated keys.

    The keys of the fullest buckets are counted exactly. The ``k``-th of them bounds the ``k``-th of
    all from below, and a bucket with fewer rows than that cannot hold a key of the result.
    """
    names = [key] if isinstance(key, str) else list(key)
    counts = written(bucket_counts(entries, names, buckets), "bucket-counts")
    fullest = written(counts.orderBy(F.desc("n"), "bucket").limit(4 * k), "fullest-buckets")
    best = _counted_in(entries, names, fullest, buckets).orderBy(F.desc("n"), *names).limit(k)
    bound = best.agg(F.count("*").alias("keys"), F.min("n").alias("least")).first()
    least = bound["least"] if bound["keys"] == k else 0
    return written(counts.filter(F.col("n") >= F.lit(least or 0)), "candidate-buckets")


def heavy_hitters(entries: DataFrame, key: str | Sequence[str], k: int, buckets: int = BUCKETS) -> DataFrame:
    """(key, n): the ``k`` most repeated keys, exactly; equal counts are ordered by key, NULL is a key.

    Three passes over the key columns: the sketch, the keys of the fullest buckets, the keys of
    the buckets that can still hold a winner. If some keys are far more frequent than a bucket's usual
    share, these are few buckets and few keys are shuffled; on flat keys all buckets remain, and
    the last pass is the plain count.
    """
    names = [key] if isinstance(key, str) else list(key)
    chosen = candidate_buckets(entries, names, k, buckets)
    return _counted_in(entries, names, chosen, buckets).orderBy(F.desc("n"), *names).limit(k)
