"""Exact duplicates by progressive refinement, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatloom.llm.text import id_key, whole_row
from flatloom.scratch import written

# The characters that do not count.
WHITE_SPACE = r"[\x20\x09-\x0D]"
PREFIX_CHARS = 64


def squeezed(text_column: str) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), WHITE_SPACE, "")


def _light(docs: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    """What the first two refinements look at: length, and the hash of the beginning."""
    text = F.col(f"`{text_column}`")
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        id_key(id_column).alias("_id"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("_chars"),
        F.octet_length(squeezed(text_column)).alias("_length"),
        # The prefix needs the beginning of the text only; white space beyond it cannot matter
        # as long as equal texts get equal prefixes, so it is cut after squeezing.
        F.xxhash64(F.substring(squeezed(text_column), 1, PREFIX_CHARS)).alias("_prefix"),
        *more,
    )


def decisions(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Which row stays of the rows whose texts are equal but for white space.

    Rows are grouped by the length of the squeezed text, then by the hash of its beginning; only
    rows whose group still has another row are read in full and grouped by the SHA-256. Returns
    one row per document: doc_id, keep_id, group_size, kept, text_sha256 (null where the content
    was never read in full), and the keys ``_id``, ``_length``, ``_prefix``, ``_chars``.

    Of equal texts the row with the most code points stays, then the smallest id. A null text
    counts as empty; a null id counts as smaller than all others. Rows with the same id and text
    cannot be told apart: they share one decision. No rows give no rows.
    """
    light = written(_light(docs, id_column, text_column), "light")
    by_prefix = light.groupBy("_length", "_prefix").agg(F.count("*").alias("_n"))
    lengths = by_prefix.groupBy("_length").agg(F.sum("_n").alias("_same_length")).filter("_same_length > 1")
    groups = by_prefix.join(lengths, "_length").filter("_n > 1").select("_length", "_prefix")
    # Written, so that Catalyst knows their size: small ones are broadcast and no text is shuffled,
    # large ones meet the texts in a shuffle, in which the rows of a large group can be split.
    groups = written(groups, "open-groups")
    closed = light.join(groups, ["_length", "_prefix"], "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lit(None).cast("string").alias("text_sha256"),
        "_id", "_length", "_prefix", "_chars",
    )
    # The keys come from the text itself, so ids, null ones too, play no part in who is read in full.
    keyed = _light(docs, id_column, text_column, F.col(f"`{text_column}`").alias("_text"))
    full = written(
        keyed.join(groups, ["_length", "_prefix"], "left_semi").select(
            "doc_id", "_id", "_chars", "_length", "_prefix", F.sha2(squeezed("_text"), 256).alias("text_sha256")
        ),
        "full",
    )
    winner = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("_id").alias("i"), F.col("doc_id").alias("d")))
    winners = written(full.groupBy("text_sha256").agg(F.count("*").alias("group_size"), winner.alias("w")), "winners")
    joined = full.join(winners, "text_sha256").select(
        "doc_id", F.col("w.d").alias("keep_id"), "group_size",
        ((F.col("_id") == F.col("w.i")) & (F.col("_chars") == -F.col("w.c"))).alias("kept"),
        "text_sha256", "_id", "_length", "_prefix", "_chars",
    )
    return closed.unionByName(joined.select(closed.columns))


def with_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The decisions with the SHA-256 of every squeezed text, also of those never compared in full."""
    found = decisions(docs, id_column, text_column).withColumnRenamed("text_sha256", "_sha").distinct()
    own = docs.select(
        id_key(id_column).alias("_id"),
        F.octet_length(squeezed(text_column)).alias("_length"),
        F.xxhash64(F.substring(squeezed(text_column), 1, PREFIX_CHARS)).alias("_prefix"),
        F.coalesce(F.char_length(F.col(f"`{text_column}`")), F.lit(0)).alias("_chars"),
        F.sha2(squeezed(text_column), 256).alias("text_sha256"),
    )
    both = own.join(found, ["_id", "_length", "_prefix", "_chars"]).filter("_sha is null or _sha = text_sha256")
    return both.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay; the columns stay as they are. Of rows repeated as a whole, one stays."""
    # By the length too: an id may come again with the same text in other white space.
    dropped = decisions(docs, id_column, text_column).filter("not kept").select(
        F.col("_id").alias("_key"), F.col("text_sha256").alias("_own"), "_chars"
    )
    # Whole rows travel in a struct, so that no name of theirs can clash.
    marked = docs.select(
        whole_row(docs), id_key(id_column).alias("_key"), F.sha2(squeezed(text_column), 256).alias("_own"),
        F.coalesce(F.char_length(F.col(f"`{text_column}`")), F.lit(0)).alias("_chars"),
    )
    left = marked.join(dropped, ["_key", "_own", "_chars"], "left_anti")
    return left.dropDuplicates(["_key", "_own"]).select("row.*")
