"""Substring dedup on bytes: run-length indexes over shards of repeated text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flatloom.llm.repeats import Repeats, without_repeats
from flatloom.llm.runindex import RunLengthIndex

# Up to 64 windows of 100 bytes share an anchor of 37 bytes.
WINDOW = 100
ANCHOR = 37


def repeated_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    output: str = "digest",
) -> DataFrame:
    """Find the bytes that a string of ``window`` bytes covers which also starts earlier.

    Shards hold all places of the strings with a certain anchor. The Burrows-Wheeler transform
    of a shard is kept as runs, with text positions sampled at their ends; matching statistics
    of every byte sequence of the shard are streamed through it, and long matches with an
    earlier place are marked. One row (row, n_units, n_removed, n_spans, kept) per input row,
    where ``row`` holds the other columns, ``n_spans`` counts the maximal removed runs and
    ``kept`` is the SHA-256 of the bytes that stay, or with ``output="text"`` these bytes. A cut
    may fall inside a character, so they are binary.

    A null text counts as empty. Rows with a null id come before all others, in the order of a
    hash of their texts, each text a document. Rows with one id are one document: of equal strings, the smallest (id, start) is the first, and rows that tie keep
    theirs. No rows give no rows. All text is read, however long.
    """
    return without_repeats(docs, Repeats("bytes", window, anchor, RunLengthIndex), id_column, text_column, output)
