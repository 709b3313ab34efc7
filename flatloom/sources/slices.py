"""Finding slice files, in the numeric order of the keys in their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatloom.functions import slice_range_start

# What the names of slice files look like, as a file pattern.
SLICE_GLOB = "*slice[.=][0-9]*-[0-9]*.json"


def slice_files(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """One row (path, slice_start, bytes) per slice file below ``root``; no content is read.

    With ``limit`` the first N in numeric order of the first key in their names, which is
    not the order of the names as text.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", SLICE_GLOB)
        .load(root)
        .select("path", slice_range_start(F.col("path")).alias("slice_start"), F.col("length").alias("bytes"))
        .filter(F.col("slice_start").isNotNull())
    )
    if limit is None:
        return files
    return files.orderBy("slice_start", "path").limit(limit)


def slice_paths(spark: SparkSession, root: str, limit: int | None = None) -> str | list[str]:
    """What to hand to a reader: the root itself, or the first ``limit`` files by number.

    Readers leave out what is no slice file, so both ways take the same kind of files. Only
    the ``limit`` chosen paths come to the driver.
    """
    if limit is None:
        return root
    return [row.path for row in slice_files(spark, root, limit).select("path").collect()]


def among_first_slices(spark: SparkSession, root: str, path: Column, limit: int) -> Column:
    """Whether a path is one of the first ``limit`` slice files, for readers that take a whole folder."""
    order = [F.desc("slice_start"), F.desc("path")]
    last = slice_files(spark, root, limit).orderBy(*order).first()
    if last is None:
        return F.lit(False)
    start = slice_range_start(path)

    def plain(p: Column) -> Column:
        # Local paths are written with one slash or with three.
        return F.regexp_replace(p, "^file:/+", "/")

    return (start < last.slice_start) | ((start == last.slice_start) & (plain(path) <= plain(F.lit(last.path))))
