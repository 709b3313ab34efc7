"""Line dedup by aligning pairs of documents that share lines."""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from flatloom.llm.text import (
    NULL_ID,
    SPACE,
    U64,
    Rolling,
    compressed,
    counted,
    decompressed,
    digests,
    id_key,
    item_hashes,
    mix,
    owners,
    runs,
    slices,
    text_buffer,
)
from flatloom.operators.numbering import positions_within
from flatloom.scratch import written

# A run of lines that at most so many documents have is rare: it brings all its documents together.
RARE_DOCUMENTS = 4
# Words that an aligned block must have to be deleted.
MIN_BLOCK_WORDS = 8


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, text, place in the text, key, words) of all lines with a word.

    The key is the hash of the line and of how many equal lines the text has before it, so that
    every key occurs once in a text.
    """
    starts, ends = runs(data != 10, offsets)
    space = SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    if len(starts):
        first[starts] = ~space[starts]
    n_words = np.concatenate([[0], np.cumsum(first)])
    size = n_words[ends] - n_words[starts]
    starts, ends, size = starts[size > 0], ends[size > 0], size[size > 0]
    text = owners(offsets, starts)
    nth = np.arange(len(text)) - np.searchsorted(text, text, "left")
    line = item_hashes(data, starts, ends)
    own = mix(line ^ mix(text.astype(U64) + U64(1)))
    order = np.argsort(own, kind="stable")
    sorted_own = own[order]
    before = np.empty(len(own), np.int64)
    before[order] = np.arange(len(own)) - np.searchsorted(sorted_own, sorted_own, "left")
    return starts, ends, text, nth, mix(line + before.astype(U64) * U64(0x9E3779B97F4A7C15)).view(np.int64), size


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text with a line: the keys of its lines in order, and their words."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        for i, j in slices(offsets):
            part = offsets[i : j + 1]
            _, _, text, _, key, size = _lines(data[part[0] : part[-1]], part - part[0])
            own, begins = np.unique(text, return_index=True)
            cuts = pa.array(np.append(begins, len(text)), pa.int32())
            columns = [batch.column(0).take(pa.array(i + own)), *(pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (key, size))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "keys", "words"])


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists one after the other, and where each list begins."""
    return np.asarray(column.flatten()), np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths()))])


def least_runs(words: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of lines with ``min_words`` words: the shortest from and up to each line.

    Every line of a block with so many words lies in one of these runs that the block holds
    whole: the shortest from the block's start on or, behind it, the shortest up to the line.
    """
    sums = np.concatenate([[0], np.cumsum(words)])
    text = owners(offsets, np.arange(len(words)))
    start = np.arange(len(words))
    end = np.searchsorted(sums, sums[:-1] + min_words, "left")
    back = np.searchsorted(sums, sums[1:] - min_words, "right") - 1
    on, up = end <= offsets[text + 1], back >= offsets[text]
    found = np.concatenate([start[on] * (len(words) + 1) + end[on], back[up] * (len(words) + 1) + start[up] + 1])
    return np.divmod(np.unique(found), len(words) + 1)


def _runs(min_words: int):
    """One row per run of a text that reaches the words of a block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, offsets = _listed(batch.column("keys"))
            words, _ = _listed(batch.column("words"))
            for i, j in slices(offsets):
                part = offsets[i : j + 1] - offsets[i]
                own = slice(offsets[i], offsets[j])
                starts, ends = least_runs(words[own], part, min_words)
                text = owners(part, starts)
                run_key = Rolling(mix(keys[own].view(U64))).ranges(starts, ends).view(np.int64)
                ids = batch.column("id").take(pa.array(i + text))
                columns = [pa.array(run_key), ids, pa.array(starts - part[text]), pa.array(ends - starts)]
                yield pa.RecordBatch.from_arrays(columns, ["run", "id", "place", "n_lines"])

    return run


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, found by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect.bisect_left(tops, value)
        if pile == len(tops):
            tops.append(value)
            at.append(i)
        else:
            tops[pile], at[pile] = value, i
        before[i] = at[pile - 1] if pile else -1
    chain, i = [], at[-1] if at else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


def aligned_blocks(earlier: list[int], later: list[int], words: list[int], min_words: int) -> list[int]:
    """The places in the later text of blocks that both texts have in the same order.

    The lists have the places of the common lines, sorted by the place in the later text. A
    block is a run of aligned lines that follow each other in both texts.
    """
    chain = longest_increasing(earlier)
    removed: list[int] = []
    block: list[int] = []
    for i in [*chain, None]:
        if block and (i is None or earlier[i] != earlier[block[-1]] + 1 or later[i] != later[block[-1]] + 1):
            if sum(words[b] for b in block) >= min_words:
                removed += [later[b] for b in block]
            block = []
        if i is not None:
            block.append(i)
    return removed


def _aligned(min_words: int):
    """Rows (b, keys_a, keys_b, words_b): all lines that both texts of a pair have are aligned."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (earlier, cuts_a), (later, cuts_b) = _listed(batch.column("keys_a")), _listed(batch.column("keys_b"))
            words, _ = _listed(batch.column("words_b"))
            out: tuple[list, list] = ([], [])
            for n, b in enumerate(batch.column("b").to_pylist()):
                own = later[cuts_b[n] : cuts_b[n + 1]]
                _, place_a, place_b = np.intersect1d(
                    earlier[cuts_a[n] : cuts_a[n + 1]], own, assume_unique=True, return_indices=True
                )
                order = np.argsort(place_b)
                place_a, place_b = place_a[order], place_b[order]
                size = words[cuts_b[n] : cuts_b[n + 1]][place_b]
                places = aligned_blocks(place_a.tolist(), place_b.tolist(), size.tolist(), min_words)
                out[0].extend([b] * len(places))
                out[1].extend(places)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64())], ["id", "place"])

    return run


def _without(output: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(decompressed(batch.column("text")))
            places = batch.column("places")
            for i, j in slices(offsets):
                part, n = offsets[i : j + 1] - offsets[i], j - i
                own = data[offsets[i] : offsets[j]]
                starts, ends, text, nth, _, _ = _lines(own, part)
                listed = places.slice(i, n)
                gone_text = np.repeat(np.arange(n), np.array(listed.value_lengths().fill_null(0), np.int64))
                gone = np.array(listed.flatten(), np.int64) + np.searchsorted(text, gone_text, "left")
                gone = np.unique(gone)
                # A line goes with the line feed after it, or the text's end.
                until = np.minimum(ends[gone] + 1, part[text[gone] + 1])
                change = np.zeros(len(own) + 1, np.int64)
                np.add.at(change, starts[gone], 1)
                np.add.at(change, until, -1)
                mask = np.cumsum(change[:-1]) == 0
                kept, kept_offsets = own[mask], np.concatenate([[0], np.cumsum(mask)])[part]
                if output == "digest":
                    last = pa.array(digests(kept, kept_offsets), pa.string())
                else:
                    last = pa.array([kept[a:b].tobytes() for a, b in zip(kept_offsets[:-1], kept_offsets[1:], strict=True)], pa.binary())
                columns = [batch.column("row").slice(i, n), pa.array(counted(text, n)), pa.array(counted(text[gone], n)), last]
                yield pa.RecordBatch.from_arrays(columns, ["row", "n_lines", "n_removed", "kept"])

    return run


def _removed(pairs: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """(id, place): what the pairs (a, b) delete from b."""
    # Written, so that the joins read both sides from shuffles and a document of many pairs can be split.
    pairs = written(pairs.distinct(), "pairs")
    later = lines.select(F.col("id").alias("b"), F.col("keys").alias("keys_b"), F.col("words").alias("words_b"))
    earlier = lines.select(F.col("id").alias("a"), F.col("keys").alias("keys_a"))
    both = pairs.join(later, "b").join(earlier, "a").select("b", "keys_a", "keys_b", "words_b")
    return both.mapInArrow(_aligned(min_words), "id binary, place long").distinct()


def aligned_removals(sources: DataFrame, rare: int, min_words: int) -> DataFrame:
    """(id, places): the lines to delete per document, by their place among lines with a word."""
    lines = written(sources.mapInArrow(_keyed, "id binary, keys array<long>, words array<long>"), "lines")
    found = lines.mapInArrow(_runs(min_words), "run long, id binary, place long, n_lines long")
    shared = (
        found.groupBy("run")
        .agg(F.count("*").alias("n"), F.min("id").alias("first"))
        .filter("n > 1")
        .select("run", "first", (F.col("n") <= rare).alias("is_rare"))
    )
    # Written, so that the join reads both sides from shuffles and a hot run can be split.
    shared = written(shared, "shared-runs")
    held = written(found.join(shared, "run"), "held-runs")
    # All documents of a rare run meet: at most `rare` rows per key are gathered.
    groups = held.filter("is_rare").groupBy("run").agg(F.collect_set("id").alias("g"))
    close = groups.select("g", F.explode("g").alias("a")).select("a", F.explode("g").alias("b")).filter("a < b")
    # A frequent run brings each document to its first one: one row per run, no pairs among the others.
    frequent = held.filter("not is_rare and id > first")
    far = frequent.select(F.col("first").alias("a"), F.col("id").alias("b"))
    removed = written(_removed(close.unionByName(far), lines, min_words), "removed-lines")
    removed = _with_later_holders(frequent.select("run", "id", "place", "n_lines"), held, removed, lines, min_words)
    return removed.groupBy("id").agg(F.collect_list("place").alias("places"))


def _with_later_holders(frequent: DataFrame, held: DataFrame, removed: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """``removed``, and what documents lose to others than the first holder of a frequent run.

    With the first holder a run may be out of order, and with a later one in order. What stays
    of such runs is tried with the second holder, the next two, the next four and so on, until it
    has gone or there are no earlier holders. So the rounds grow with the logarithm of the holders.
    """
    left, holders, tried, width = frequent, None, 1, 1
    while True:
        # A run is tried as long as a line of it stays.
        each = left.withColumn("line", F.explode(F.sequence("place", F.col("place") + F.col("n_lines") - 1)))
        gone = removed.select("id", F.col("place").alias("line"))
        staying = each.join(gone, ["id", "line"], "left_anti").select(*left.columns).distinct()
        left = written(staying, "staying-runs")
        if holders is None:
            if left.isEmpty():
                return removed
            # Only now are the holders numbered, and only those of runs that stay somewhere.
            wanted = left.select("run").distinct()
            ids = held.join(wanted, "run", "left_semi").select("run", "id").distinct()
            holders = written(positions_within(ids, "run", ["id"], "nth"), "holders")
            left = left.join(holders, ["run", "id"])
        left = written(left.filter(F.col("nth") > tried), "untried-runs")
        if left.isEmpty():
            return removed
        some = holders.filter(F.col("nth").between(tried, tried + width - 1)).select("run", F.col("id").alias("a"))
        pairs = left.select("run", F.col("id").alias("b")).join(some, "run").filter("a < b").select("a", "b")
        more = _removed(pairs, lines, min_words)
        removed = written(removed.unionByName(more).distinct(), "removed-lines")
        tried, width = tried + width, 2 * width


def _document(id_column: str, text_column: str) -> Column:
    """``id``: 16 bytes in the order of the ids, then of a hash of the text, so that rows that share an id are told apart."""
    above_zero = id_key(id_column).bitwiseXOR(F.lit(NULL_ID))
    content = F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    return F.unhex(F.concat(*(F.lpad(F.hex(x), 16, "0") for x in (above_zero, content)))).alias("id")


def without_aligned_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rare: int = RARE_DOCUMENTS,
    min_words: int = MIN_BLOCK_WORDS,
    output: str = "digest",
) -> DataFrame:
    """(row, n_lines, n_removed, kept) per document; ``row`` holds the columns but the text.

    Lines are compared whole; those without a word do not count. Each document is held against
    every earlier one. The lines that such a pair has in common are aligned by patience: the
    longest sequence that both have in the same order. Blocks of aligned lines that follow each
    other in both and have ``min_words`` words or more are deleted from the later document. The
    k-th of equal lines in a document is aligned with the k-th of another. A line always stays
    in the first document that has it.

    Only pairs that share a run of lines with so many words can have a block, and only these
    are aligned. A run that at most ``rare`` documents have brings all of them together. A more
    frequent one brings each document to the first holder, and to later ones for as long as a
    line of it stays.

    ``kept`` is the SHA-256 of the text that stays, or with ``output="text"`` its bytes. A null
    or empty text has no lines. A null id counts as an id below all others. Rows that share an id
    are documents of their own, in the order of a hash of their texts; rows equal in both are
    no pair, and what is deleted from one is deleted from each. No rows give no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("row")
    sources = docs.select(_document(id_column, text_column), F.col(f"`{text_column}`").alias("text"))
    removals = written(aligned_removals(sources, rare, min_words), "removals")
    whole = compressed(docs.select(row, _document(id_column, text_column), F.col(f"`{text_column}`").alias("text")))
    # The removals grow with the documents, so the join is the same for few of them as for many.
    joined = whole.join(removals.hint("merge"), "id", "left").select("row", "text", "places")
    kept = StringType() if output == "digest" else BinaryType()
    counts = [StructField("n_lines", LongType()), StructField("n_removed", LongType())]
    return joined.mapInArrow(_without(output), StructType([joined.schema["row"], *counts, StructField("kept", kept)]))
