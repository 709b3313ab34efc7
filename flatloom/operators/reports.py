"""Reports over run results: latest runs per loader, medians, rates and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatloom.functions import bounded_rate
from flatloom.scratch import written


def latest_runs(runs: DataFrame, group: str, newest_first: Sequence[Column], k: int = 3) -> DataFrame:
    """The last ``k`` rows per group.

    Catalyst applies the rank limit before the shuffle as well, so each input
    partition sends at most ``k`` rows per group.
    """
    order = Window.partitionBy(group).orderBy(*newest_first)
    return runs.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")


def with_label(rows: DataFrame, labels: DataFrame, code: str, keep_unknown: bool = True, name: str = "label") -> DataFrame:
    """Add the label of a code. Unknown codes label themselves, or are dropped.

    ``labels`` is a (code, label) table; of several labels for a code the smallest counts, so
    that no row is multiplied. They are written, so that Catalyst knows their size in bytes and
    broadcasts them if that allows.
    """
    one = written(labels.groupBy("code").agg(F.min("label").alias("_label")), "labels")
    lookup = one.select(F.col("code").alias(code), "_label")
    joined = rows.join(lookup, code, "left" if keep_unknown else "inner")
    return joined.withColumn(name, F.coalesce("_label", code)).drop("_label")


def throughput(
    runs: DataFrame,
    group: str,
    newest_first: Sequence[Column],
    load: str,
    constraints: str,
    entries: Column,
    k: int = 3,
) -> DataFrame:
    """Per group: medians of the latest ``k`` runs, their sum, the rate and the number of runs.

    The total is the sum of the two medians, not the median of the totals. Groups hold at
    most ``k`` rows when the medians are taken.
    """
    latest = latest_runs(runs, group, newest_first, k).withColumn("_entries", entries)
    stats = latest.groupBy(group).agg(
        F.median(load).alias("med_load"),
        F.median(constraints).alias("med_constraints"),
        F.max("_entries").alias("_entries"),
        F.count("*").alias("runs"),
    )
    return stats.select(
        group,
        "med_load",
        "med_constraints",
        (F.col("med_load") + F.col("med_constraints")).alias("total"),
        bounded_rate(F.col("_entries"), F.col("med_load")).alias("rate"),
        "runs",
    ).orderBy("med_load", group)
