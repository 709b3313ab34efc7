"""Runs of slices of about equal size, for loads that take so many bytes at a time."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def _starts(sums: np.ndarray, bound: int, most: int) -> list[int]:
    """Where chunks begin if each takes slices for as long as they fit; stops beyond ``most`` chunks."""
    starts, at = [], 0
    while at < len(sums) - 1 and len(starts) <= most:
        starts.append(at)
        at = int(np.searchsorted(sums, sums[at] + bound, "right")) - 1
    return starts


def smallest_bound(sizes: np.ndarray, chunks: int) -> int:
    """The smallest size such that ``chunks`` runs of consecutive slices, none larger, hold all of them."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    low, high = int(sizes.max(initial=0)), int(sums[-1])
    while low < high:
        middle = (low + high) // 2
        if len(_starts(sums, middle, chunks)) <= chunks:
            high = middle
        else:
            low = middle + 1
    return low


def balanced_chunks(slices: DataFrame, column: str, size: str, chunks: int) -> DataFrame:
    """(slice, size, chunk_id): at most ``chunks`` runs of consecutive slices, the largest as small as can be.

    Of the ways to reach that size, each chunk takes as many slices as fit. ``size`` is a whole number, in
    bytes or rows; NULL counts as 0, and rows of one slice are added up. The sizes of the slices come to the driver,
    one number each, as the listing of their files does; of the data nothing.
    """
    if chunks < 1:
        raise ValueError(f"chunks must be 1 or more, not {chunks}")
    added = slices.groupBy(column).agg(F.coalesce(F.sum(size), F.lit(0)).cast("long").alias(size))
    rows = added.orderBy(column).collect()
    sizes = np.array([r[size] for r in rows], np.int64)
    if (sizes < 0).any():
        raise ValueError("a slice has a size below zero")
    sums = np.concatenate([[0], np.cumsum(sizes)])
    starts = _starts(sums, smallest_bound(sizes, chunks), len(sizes))
    number = np.searchsorted(starts, np.arange(len(sizes)), "right") - 1
    schema = StructType([added.schema[column], added.schema[size], StructField("chunk_id", LongType())])
    return slices.sparkSession.createDataFrame([(*r, int(n)) for r, n in zip(rows, number, strict=True)], schema)
