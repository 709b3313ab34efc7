"""Finding what a window of words or bytes repeats, over all documents.

1. Every document is cut into regions by anchors (``windows``). Anchors that occur once in
   the whole corpus cannot belong to a repeated window, and their regions go no further.
2. Regions are dealt to shards by anchor, so that all places of a window meet in one shard.
   A shard is indexed and its regions are streamed through it (``matching``), which tells
   the first place of each window; only first places are reported.
3. An anchor with more than ``HOT`` occurrences is not gathered: its windows are dealt one
   by one, by the hash of their content, and their first places found by an aggregate with a
   partial step. The result is the same.
4. Per document, the windows of regions that passed step 1 and are no first place repeat
   something earlier; what they cover is removed.

Rows with one id count as one document for what is earlier: of windows with equal content, the
one with the smallest id, then the smallest start is the first, and a tie keeps both. Rows without
an id are documents of their own before all others, in the order of a hash of their texts; those with
one text count as one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from flatloom.llm.matching import first_windows
from flatloom.llm.text import (
    NULL_ID,
    SPACE,
    U64,
    Rolling,
    byte_values,
    compressed,
    counted,
    decompressed,
    digests,
    mix,
    owners,
    slices,
    text_buffer,
    words,
)
from flatloom.llm.windows import regions
from flatloom.scratch import release, written

# Occurrences of an anchor up to which its regions are gathered in one shard.
HOT = 4096
# Contents that a task remembers, so as to send copies once; it then forgets and starts anew.
REMEMBERED = 500_000
# Symbols, about, that are indexed together: what fits the processor's cache is fastest.
SHARD_SYMBOLS = 1 << 17


@dataclass(frozen=True)
class Repeats:
    """What repeats: windows of ``window`` words or bytes, with anchors of ``k`` of them."""

    unit: str
    window: int
    k: int
    index_type: Callable


@dataclass
class _Slice:
    """Some documents: bytes, their symbols with a value each, and their regions."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    owner: np.ndarray
    anchor: np.ndarray
    start: np.ndarray
    count: np.ndarray
    # The hash of what the windows of each region cover; left out where only anchors are wanted.
    content: np.ndarray | None


def _symbols(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, 64-bit value) of each symbol."""
    if unit == "words":
        starts, ends = words(data, offsets)
        return starts, ends, Rolling(byte_values(data)).ranges(starts, ends)
    starts = np.arange(len(data))
    return starts, starts + 1, byte_values(data)


def _cut(data: np.ndarray, offsets: np.ndarray, what: Repeats, wanted: np.ndarray | None) -> _Slice:
    """The regions of the texts marked in ``wanted``; with None of all texts, without contents."""
    starts, ends, values = _symbols(data, offsets, what.unit)
    bounds = offsets if what.unit == "bytes" else np.searchsorted(starts, offsets)
    sizes = np.diff(bounds)
    if wanted is None:
        found = regions(values, bounds, what.window, what.k)
        owner = owners(bounds, found.start)
        return _Slice(data, offsets, starts, ends, bounds, owner, found.anchor, found.start, found.count, None)
    if not wanted.all():
        values = values[np.repeat(wanted, sizes)]
    some = np.concatenate([[0], np.cumsum(sizes[wanted])])
    found = regions(values, some, what.window, what.k)
    content = Rolling(values).ranges(found.start, found.start + found.count + what.window - 1).view(np.int64)
    owner = owners(some, found.start)
    start = found.start - some[owner]
    owner = np.flatnonzero(wanted)[owner]
    return _Slice(data, offsets, starts, ends, bounds, owner, found.anchor, start + bounds[owner], found.count, content)


def _sliced(batch: pa.RecordBatch, what: Repeats, packed: bool = True) -> Iterator[tuple[int, int, _Slice]]:
    """Slices of a batch; documents without listed anchors, where there are lists, have no regions."""
    column = batch.column("text")
    data, offsets = text_buffer(decompressed(column) if packed else column)
    wanted = np.zeros(batch.num_rows, bool)
    lists = [n for n in ("cold", "hot") if n in batch.schema.names]
    for name in lists:
        wanted |= np.array(batch.column(name).value_lengths().fill_null(0)) > 0
    for i, j in slices(offsets):
        part = offsets[i : j + 1]
        some = wanted[i:j] if lists else None
        yield i, j, _cut(data[part[0] : part[-1]], part - part[0], what, some)


def _anchors(what: Repeats):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for i, _, cut in _sliced(batch, what, packed=False):
                yield pa.RecordBatch.from_arrays([pa.array(ids[i + cut.owner]), pa.array(cut.anchor)], ["id", "anchor"])

    return run


def _paired(owner: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return mix(anchor.view(U64) + owner.astype(U64) * U64(0x9E3779B97F4A7C15))


def _listed(column: pa.Array, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner from 0, value) of the lists of rows ``i`` to ``j``; a null list is empty."""
    part = column.slice(i, j - i)
    lengths = np.array(part.value_lengths().fill_null(0), np.int64)
    return np.repeat(np.arange(j - i), lengths), part.flatten()


def _chosen(cut: _Slice, column: pa.Array, i: int, j: int) -> np.ndarray:
    """The regions whose anchor is listed for their document."""
    owner, values = _listed(column, i, j)
    wanted = _paired(owner, np.array(values, np.int64))
    return np.flatnonzero(np.isin(_paired(cut.owner, cut.anchor), wanted))


def _smallest(keys: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One place per key: the smallest id, then the smallest start."""
    order = np.lexsort((starts, ids, keys))
    ordered = keys[order]
    new = np.ones(len(order), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return order[new]


def _texts(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The given ranges of ``data`` as binary values."""
    lengths = end - begin
    ends = np.cumsum(lengths)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - lengths), lengths)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), buffers).cast(pa.binary())


_REGION = pa.schema(
    [("anchor", pa.int64()), ("content", pa.int64()), ("id", pa.int64()), ("start", pa.int64()), ("count", pa.int32()), ("bytes", pa.binary())]
)


def _contents(what: Repeats):
    """The regions with listed anchors; of copies within a task, the first.

    A task remembers the smallest place of each content it has sent. One that comes later with
    a smaller place is sent as well, so the order of the documents does not matter.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, tuple[int, int]] = {}

        def news(content: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> list[int]:
            out = []
            for n, (c, *place) in enumerate(zip(content.tolist(), ids.tolist(), starts.tolist(), strict=True)):
                place = tuple(place)
                if c not in sent or place < sent[c]:
                    sent[c] = place
                    out.append(n)
            return out

        for batch in batches:
            ids = np.asarray(batch.column(0))
            for i, j, cut in _sliced(batch, what):
                pick = _chosen(cut, batch.column(2), i, j)
                starts = cut.start[pick] - cut.bounds[cut.owner[pick]]
                pick = pick[_smallest(cut.content[pick], ids[i + cut.owner[pick]], starts)]
                starts = cut.start[pick] - cut.bounds[cut.owner[pick]]
                if len(sent) > REMEMBERED:
                    sent.clear()
                pick = pick[np.array(news(cut.content[pick], ids[i + cut.owner[pick]], starts), np.int64)]
                owner, first = cut.owner[pick], cut.start[pick]
                last = first + cut.count[pick] + what.window - 2
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cut.anchor[pick]),
                        pa.array(cut.content[pick]),
                        pa.array(ids[i + owner]),
                        pa.array(first - cut.bounds[owner]),
                        pa.array(cut.count[pick].astype(np.int32)),
                        _texts(cut.data, cut.starts[first], cut.ends[last]),
                    ],
                    schema=_REGION,
                )

    return run


def _single_windows(what: Repeats):
    """Each window of the regions with listed anchors, by the hash of its content."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for i, j, cut in _sliced(batch, what):
                pick = _chosen(cut, batch.column(2), i, j)
                owner = np.repeat(cut.owner[pick], cut.count[pick])
                total = int(cut.count[pick].sum())
                nth = np.arange(total) - np.repeat(np.cumsum(cut.count[pick]) - cut.count[pick], cut.count[pick])
                at = np.repeat(cut.start[pick], cut.count[pick]) + nth
                _, _, values = _symbols(cut.data, cut.offsets, what.unit)
                # Two hashes of the content, so that only equal windows are taken together.
                low = Rolling(values).ranges(at, at + what.window).view(np.int64)
                high = Rolling(mix(values)).ranges(at, at + what.window).view(np.int64)
                keep = _smallest(low, ids[i + owner], at - cut.bounds[owner])
                names = ["low", "high", "id", "start", "content", "nth"]
                columns = [low, high, ids[i + owner], at - cut.bounds[owner], np.repeat(cut.content[pick], cut.count[pick]), nth]
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names)

    return run


def _shard_symbols(column: pa.Array, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """(symbols from 1, how many each region has)."""
    data, offsets = text_buffer(column)
    starts, ends, values = _symbols(data, offsets, unit)
    if unit == "bytes":
        used = np.zeros(256, bool)
        used[data] = True
        return np.cumsum(used)[data], np.diff(offsets)
    _, symbols = np.unique(values, return_inverse=True)
    return symbols + 1, np.diff(np.searchsorted(starts, offsets))


def _shard(table: pa.Table, what: Repeats) -> pa.RecordBatch:
    """The first places among the regions of a shard."""
    table = table.combine_chunks()
    anchor, content, ids, starts = (np.asarray(table.column(n)) for n in ("anchor", "content", "id", "start"))
    pick = _smallest(mix(anchor.view(U64)) ^ content.view(U64), ids, starts)
    table = table.take(pa.array(pick))
    content, ids, starts, counts = (np.asarray(table.column(n)) for n in ("content", "id", "start", "count"))
    symbols, lengths = _shard_symbols(table.column("bytes").combine_chunks(), what.unit)
    # Places that follow the order of (id, start) and are the same for the same place.
    _, dense = np.unique(ids, return_inverse=True)
    places = dense * (int((starts + counts).max(initial=0)) + 1) + starts
    masks = first_windows(what.index_type, symbols, lengths, counts.astype(np.int64), places, what.window)
    some = masks != 0
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[some]), pa.array(starts[some]), pa.array(content[some]), pa.array(masks[some].view(np.int64))],
        ["id", "start", "content", "mask"],
    )


def _shards(what: Repeats):
    """Gather whole anchors, which arrive sorted, up to the size of a shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                weight = part.column("bytes").nbytes
                if held and size + weight > SHARD_SYMBOLS * (6 if what.unit == "words" else 1):
                    table = pa.Table.from_batches([*held, part])
                    anchor = np.asarray(table.column("anchor").combine_chunks())
                    whole = int(np.searchsorted(anchor, anchor[-1], "left"))
                    if whole:
                        yield _shard(table.slice(0, whole), what)
                        rest = table.slice(whole)
                        held, size = rest.to_batches(), int(np.sum([b.column("bytes").nbytes for b in rest.to_batches()]))
                        continue
                held.append(part)
                size += weight
        if held:
            yield _shard(pa.Table.from_batches(held), what)

    return run


def candidates(docs: DataFrame, what: Repeats) -> DataFrame:
    """(id, cold, hot) of documents with repeated anchors: lists of these, by how frequent they are."""
    anchors = docs.mapInArrow(_anchors(what), "id long, anchor long")
    counts = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    # Written, so that the join reads both sides from shuffles and a hot anchor can be split.
    repeated = written(counts, "anchor-counts")
    pairs = anchors.join(repeated, "anchor").select("id", "anchor", (F.col("n") > HOT).alias("is_hot"))
    return pairs.groupBy("id").agg(
        F.collect_set(F.expr("if(is_hot, null, anchor)")).alias("cold"),
        F.collect_set(F.expr("if(is_hot, anchor, null)")).alias("hot"),
    )


def first_places(docs: DataFrame, listed: DataFrame, what: Repeats) -> DataFrame:
    """(id, start, content, mask): of each region, the windows that occur nowhere earlier."""
    texts = docs.join(listed, "id")
    contents = texts.select("id", "text", "cold").mapInArrow(
        _contents(what), "anchor long, content long, id long, start long, count int, bytes binary"
    )
    dealt = contents.repartition("anchor").sortWithinPartitions("anchor")
    cold = dealt.mapInArrow(_shards(what), "id long, start long, content long, mask long")
    singles = (
        texts.filter(F.size("hot") > 0)
        .select("id", "text", "hot")
        .mapInArrow(_single_windows(what), "low long, high long, id long, start long, content long, nth long")
    )
    # The smallest of (id, start) by an aggregate; nth and content go along.
    firsts = singles.groupBy("low", "high").agg(F.min(F.struct("id", "start", "nth", "content")).alias("f"))
    hot = firsts.select(
        F.col("f.id"),
        (F.col("f.start") - F.col("f.nth")).alias("start"),
        F.col("f.content"),
        F.expr("shiftleft(1L, cast(f.nth as int))").alias("mask"),
    )
    return cold.unionByName(hot)


def _covered(cut: _Slice, i: int, j: int, batch: pa.RecordBatch, what: Repeats) -> np.ndarray:
    """Which symbols a window covers that also starts earlier."""
    repeated = np.zeros(len(cut.starts) + 1, bool)
    for name in ("cold", "hot"):
        pick = _chosen(cut, batch.column(name), i, j)
        total = int(cut.count[pick].sum())
        nth = np.arange(total) - np.repeat(np.cumsum(cut.count[pick]) - cut.count[pick], cut.count[pick])
        repeated[np.repeat(cut.start[pick], cut.count[pick]) + nth] = True
    owner, kept = _listed(batch.column("kept"), i, j)
    if len(owner):
        start, content, mask = (np.array(kept.field(n), np.int64) for n in ("start", "content", "mask"))
        at = start + cut.bounds[owner]
        # Only a region with the same place and content is meant, as rows may share an id.
        spot = np.minimum(np.searchsorted(cut.start, at), max(len(cut.start) - 1, 0))
        real = (cut.start[spot] == at) & (cut.content[spot] == content) if len(cut.start) else np.zeros(len(at), bool)
        at, mask = at[real], mask[real].view(U64)
        for bit in range(what.window - what.k + 1):
            set_here = (mask >> U64(bit)) & U64(1) == U64(1)
            repeated[at[set_here] + bit] = False
    first = np.flatnonzero(repeated)
    edges = np.zeros(len(cut.starts) + 1, np.int32)
    np.add.at(edges, first, 1)
    np.add.at(edges, first + what.window, -1)
    return np.cumsum(edges[:-1]) > 0


def _kept_words(cut: _Slice, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the words that stay, joined by one space."""
    owner = owners(cut.bounds, np.arange(len(cut.starts)))
    stay = np.flatnonzero(~covered)
    change = np.zeros(len(cut.data) + 1, np.int8)
    change[cut.starts[stay]] += 1
    change[cut.ends[stay]] -= 1
    mask = np.cumsum(change[:-1], dtype=np.int8) > 0
    # All but the last word of a document are followed by a byte, which becomes the space.
    followed = np.zeros(len(stay), bool)
    followed[:-1] = owner[stay[1:]] == owner[stay[:-1]]
    gaps = cut.ends[stay[followed]]
    data = cut.data.copy()
    data[gaps] = 32
    mask[gaps] = True
    return data[mask], np.concatenate([[0], np.cumsum(mask)])[cut.offsets]


def _cut_words(cut: _Slice, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts without the removed words and the white space after each."""
    drop = np.zeros(len(cut.data) + 1, np.int8)
    gone = np.flatnonzero(covered)
    owner = owners(cut.bounds, gone)
    until = np.append(cut.starts, len(cut.data))[gone + 1]
    until = np.minimum(until, cut.offsets[owner + 1])
    drop[cut.starts[gone]] += 1
    np.add.at(drop, until, -1)
    mask = np.cumsum(drop[:-1], dtype=np.int8) == 0
    return cut.data[mask], np.concatenate([[0], np.cumsum(mask)])[cut.offsets]


def _results(what: Repeats, output: str, extra: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, cut in _sliced(batch, what):
                covered = _covered(cut, i, j, batch, what)
                n = j - i
                sizes = np.diff(cut.bounds)
                sums = np.concatenate([[0], np.cumsum(covered)])[cut.bounds]
                begins = covered.copy()
                begins[1:] &= ~covered[:-1]
                bounds = cut.bounds[:-1][cut.bounds[:-1] < len(covered)]
                begins[bounds] = covered[bounds]
                spans = counted(owners(cut.bounds, np.flatnonzero(begins)), n)
                columns = [batch.column(name).slice(i, n) for name in extra]
                columns += [pa.array(sizes.astype(np.int64)), pa.array(np.diff(sums).astype(np.int64)), pa.array(spans)]
                if output == "text":
                    data, offsets = _cut_words(cut, covered) if what.unit == "words" else (cut.data[~covered], None)
                else:
                    data, offsets = _kept_words(cut, covered) if what.unit == "words" else (cut.data[~covered], None)
                if offsets is None:
                    offsets = np.concatenate([[0], np.cumsum(~covered)])[cut.offsets]
                if output == "digest":
                    columns.append(pa.array(digests(data, offsets), pa.string()))
                else:
                    columns.append(_texts(data, offsets[:-1], offsets[1:]))
                names = [*extra, "n_units", "n_removed", "n_spans", "kept"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _document_key(id_column: str, text_column: str) -> Column:
    """The id; without one, a key of the text's own below all ids from -2^62 on.

    So rows without an id, however many, are not gathered under one key. An id that is smaller still
    may share a key with such a row, and the two then count as rows with one id.
    """
    own = F.lit(NULL_ID) + F.shiftrightunsigned(F.xxhash64(F.col(f"`{text_column}`")), 2)
    return F.coalesce(F.col(f"`{id_column}`").cast("long"), own)


def without_repeats(docs: DataFrame, what: Repeats, id_column: str, text_column: str, output: str) -> DataFrame:
    """(row, n_units, n_removed, n_spans, kept) for every row of ``docs``; ``row`` has its other columns.

    ``output`` says what ``kept`` holds: the ``digest`` of what stays, or the ``text`` itself as
    bytes. The operators that call this state the rules for nulls and ties.
    """
    sources = docs.select(_document_key(id_column, text_column).alias("id"), F.col(f"`{text_column}`").alias("text"))
    # Small next to the texts: eight bytes per repeated anchor. Written, as two steps read it.
    listed = written(candidates(sources, what), "repeated-anchors")
    release(docs.sparkSession)
    firsts = first_places(compressed(sources), listed, what).groupBy("id").agg(
        F.collect_list(F.struct("start", "content", "mask")).alias("kept")
    )
    marks = written(listed.join(firsts, "id", "left"), "first-places")
    del firsts
    release(docs.sparkSession)
    # The other columns travel in a struct, so that their names cannot clash with those used here.
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("row")
    rows = docs.select(others, _document_key(id_column, text_column).alias("id"), F.col(f"`{text_column}`").alias("text"))
    joined = compressed(rows).join(marks, "id", "left").select("row", "text", "cold", "hot", "kept")
    kept = StringType() if output == "digest" else BinaryType()
    counts = [StructField(name, LongType()) for name in ("n_units", "n_removed", "n_spans")]
    schema = StructType([joined.schema["row"], *counts, StructField("kept", kept)])
    return joined.mapInArrow(_results(what, output, ["row"]), schema)
