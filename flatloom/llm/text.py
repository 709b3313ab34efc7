"""Texts of an Arrow batch as one byte array, with vectorised words, lines and hashes.

A hash here is a polynomial over 64-bit values, taken modulo 2**64 from prefix sums and then
mixed. It is a pure function of the bytes, so equal texts agree on every executor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# A value per byte that does not follow the order of the bytes.
_BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
# Work on about this many bytes at a time, which keeps the temporaries in the processor's cache.
SLICE_BYTES = 1 << 16
# Bytes from which on a range is hashed as a whole.
LONG_ITEM = 512

_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]

# Null ids count as one id below all others.
NULL_ID = -(2**63)


def id_key(column: str) -> Column:
    """The integer id used for ordering and joining; a null id counts as the smallest."""
    return F.coalesce(F.col(f"`{column}`").cast("long"), F.lit(NULL_ID))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, named ``row``."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    if column.null_count:
        column = pc.fill_null(column, b"" if kind == pa.large_binary() else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def compressed(df: DataFrame, column: str = "text") -> DataFrame:
    """``df`` with a text column in Zstandard form, for texts that are to be shuffled; null counts as empty."""
    others = [c for c in df.columns if c != column]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            data, offsets = text_buffer(batch.column(column))
            view, cuts = memoryview(data), offsets.tolist()
            packed = [pack(view[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            columns = [*(batch.column(c) for c in others), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*others, column])

    schema = StructType([*(df.schema[c] for c in others), StructField(column, BinaryType())])
    return df.select(*others, column).mapInArrow(run, schema)


def decompressed(column: pa.Array) -> pa.Array:
    """The texts of a compressed column."""
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(x) for x in column.to_pylist()], pa.large_binary())


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with at most ``limit`` bytes each, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit values over all their bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, SLICE_BYTES + 1), base, U64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Rolling:
    """Prefix sums that give the hash of any range of a sequence in constant time."""

    def __init__(self, values: np.ndarray):
        up, self._down = _power_tables(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    def grams(self, k: int) -> np.ndarray:
        """An unmixed hash of every range of ``k`` values."""
        n = len(self._sums) - k
        return (self._sums[k:] - self._sums[:n]) * self._down[:n]

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each range; it depends on the content and the length alone."""
        h = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(h + (ends - starts).astype(U64))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def item_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each range of bytes.

    Polynomials modulo 2**64 agree on some different texts of 1,024 bytes and more, whatever their
    base; so long ranges are hashed by XXH64, of which no such texts are known.
    """
    found = Rolling(byte_values(data)).ranges(starts, ends)
    view = memoryview(np.ascontiguousarray(data))
    for i in np.flatnonzero(ends - starts >= LONG_ITEM).tolist():
        found[i] = xxhash.xxh64_intdigest(view[starts[i] : ends[i]], seed=LONG_ITEM)
    return found


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes; no run crosses a text boundary."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(inside)]
    first[begins] = inside[begins]
    stops = offsets[1:][offsets[1:] > 0] - 1
    last[stops] = inside[stops]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``."""
    return runs(~SPACE[data], offsets)


def owners(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The text that each position lies in."""
    return np.searchsorted(offsets, positions, "right") - 1


def counted(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """How many items, or how much weight, each of ``n`` texts has."""
    return np.bincount(owner, weights, n).astype(np.int64)


def digests(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The SHA-256 of each text."""
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
