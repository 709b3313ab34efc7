"""Packing tokenised documents into sequences of bounded length by the sum-of-squares rule."""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from flatloom.scratch import written

SEQUENCE_TOKENS = 1024
END_ID = 2
# Pieces packed together: enough that what the last open sequences waste is a small part, few
# enough that a task holds them with their ids.
GROUP_PIECES = 8192


@functools.cache
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids for a tokenizer file; strings of special tokens are ordinary text.

    A plain byte-level BPE whose ids follow its merges is run by tiktoken, which gives the same
    ids several times faster; anything else by the tokenizers library.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and not spec.get("normalizer")
        and not model.get("byte_fallback")
    )
    if plain:
        special = {t["content"] for t in spec.get("added_tokens", [])}
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        joined = [t.replace(" ", "") if isinstance(t, str) else "".join(t) for t in model["merges"]]
        ids = [model["vocab"][t] for t in joined]
        if ids == sorted(ids):
            fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            return lambda text: np.array(fast.encode_ordinary(text), np.uint32)
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        number = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for r, text in enumerate(part.column(1).to_pylist()):
                    tokens = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                    # The first piece takes what the whole ones leave.
                    first = len(tokens) % capacity or capacity
                    cuts = [0, *range(first, len(tokens) + 1, capacity)]
                    for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        row.append(r)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(tokens[a:b].tobytes()))
                        if with_ids:
                            ids.append(tokens[a:b].view("<i4"))
                columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                columns.append(pa.array(number + np.arange(len(row))))
                number += len(row)
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                names = ["row", "piece", "start", "length", "ids_crc32", "number", *(["ids"] if with_ids else [])]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item, packed longest first.

    Bins count by residual gap only. An item goes where the sum over gaps of the squared number
    of open bins becomes smallest, the tightest gap on a tie; a new bin is opened if no open one
    has room.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins = np.zeros(capacity + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    for item in np.argsort(-lengths, kind="stable"):
        size = int(lengths[item])
        gaps = size + np.flatnonzero(open_bins[size:capacity])
        if len(gaps):
            # Taking a bin from gap g to g - size changes the sum by twice this, plus two;
            # a bin that becomes full is no longer counted.
            change = np.where(gaps > size, open_bins[gaps - size] + 1, 0) - open_bins[gaps]
            gap = int(gaps[np.argmin(change)])
            chosen = by_gap[gap].pop()
            open_bins[gap] -= 1
        else:
            gap, chosen = capacity, opened
            opened += 1
        bins[item], offsets[item] = chosen, capacity - gap
        if gap > size:
            by_gap[gap - size].append(chosen)
            open_bins[gap - size] += 1
    return bins, offsets


def _packer(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        # The order within a group is fixed, so that a repeated task packs the same way.
        order = np.lexsort([np.asarray(table.column(n)) for n in ("number", "ids_crc32", "start")])
        table = table.take(pa.array(order))
        bins, offsets = sum_of_squares(np.asarray(table.column("length")), capacity)
        group = int(table.column("group")[0].as_py()) if table.num_rows else 0
        out = table.drop_columns(["group", "number"])
        return out.append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(offsets))

    return run


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    text_column: str = "text",
    capacity: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(row, piece, start, length, ids_crc32[, ids], sequence_id, offset), one row per piece.

    A document is the ids of its text and ``end_id``. Documents longer than ``capacity`` are cut
    into pieces of that length, the first of which may be shorter. Pieces are dealt at random to
    groups of about ``GROUP_PIECES``; each group is packed on its own by ``sum_of_squares``, so a
    task holds one group and the only loss against one large group is a few part-filled
    sequences in each. ``row`` holds the other columns.

    A null or empty text is the end id alone. Repeated rows are packed each on its own, whatever
    their ids. No rows give no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("row")
    sources = docs.select(row, F.col(f"`{text_column}`").alias("text"))
    longs = [StructField(name, LongType()) for name in ("start", "length", "ids_crc32", "number")]
    fields = [sources.schema["row"], StructField("piece", IntegerType()), *longs]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))
    # Written, since the number of groups depends on the number of pieces.
    cut = _pieces(tokenizer_path, capacity, end_id, with_ids)
    pieces = written(sources.mapInArrow(cut, StructType(fields)), "pieces")
    groups = -(-pieces.count() // GROUP_PIECES)
    dealt = F.pmod(F.xxhash64("ids_crc32", "start", "number", "length"), F.lit(max(1, groups))).alias("group")
    kept = [f for f in fields if f.name != "number"]
    schema = StructType([*kept, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return pieces.select("*", dealt).groupBy("group").applyInArrow(_packer(capacity), schema)
