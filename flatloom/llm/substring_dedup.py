"""Substring dedup on words: compressed full-text indexes over shards of repeated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatloom.llm.repeats import Repeats, without_repeats
from flatloom.llm.wavelet import FmIndex

# An anchor of 8 words: rare enough by chance, and a window of 20 words still holds 13 of them.
WINDOW = 20
ANCHOR = 8


def repeated_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    output: str = "digest",
) -> DataFrame:
    """Find the words that a window of ``window`` words covers which also starts earlier.

    Shards hold all places of the windows with a certain anchor. Each is indexed by a wavelet
    matrix over the Burrows-Wheeler transform of its word sequences; backward search then
    streams every sequence of the shard through the index and reports the windows whose match
    reaches ``window`` words at an earlier place. One row (row, n_units, n_removed, n_spans,
    kept) per input row, where ``row`` holds the other columns and ``kept`` the SHA-256 of the
    words that stay, or with ``output="text"`` the text without the removed words.

    A null or empty text has no words. Rows with a null id come before all others, in the order
    of a hash of their texts, each text a document. Rows with one id are one document: of equal
    windows, the smallest (id, start) is the first, and rows that tie keep theirs. No rows give no rows. All text is read, however long.
    """
    return without_repeats(docs, Repeats("words", window, anchor, FmIndex), id_column, text_column, output)


def without_repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with repeated words cut out of their texts; the columns stay as they are.

    A word goes with the white space after it. A null text comes back empty.
    """
    found = repeated_words(docs, id_column, text_column, output="text")
    text = F.decode("kept", "UTF-8").alias(text_column)
    others = [F.col(f"row.`{c}`").alias(c) if c != text_column else text for c in docs.columns]
    return found.select(*others)
