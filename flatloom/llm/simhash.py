"""Near-duplicates by SimHash fingerprints, linked with the help of vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from flatloom.llm.components import components
from flatloom.llm.text import LOWER, NULL_ID, U64, id_key, slices, text_buffer, whole_row, words
from flatloom.llm.vptree import VantageTree, block_masks
from flatloom.scratch import written

SHINGLE_WORDS = 4
MAX_BITS_APART = 4
SEED = 42
# The trees are fitted on this many fingerprints at most; every fingerprint is placed in them.
TREE_SAMPLE = 32768
# Fingerprints aimed at per leaf, the deepest tree, and the members that one task holds of a leaf.
LEAF_TARGET = 2048
MAX_LEVELS = 20
TILE_MEMBERS = 16384
HASHES_AT_ONCE = 1 << 16


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(words in lower case joined by one space; text, start and end of every shingle in them)."""
    data = LOWER[data]
    starts, ends = words(data, offsets)
    lengths = ends - starts
    # All words with one space after each.
    after = np.cumsum(lengths + 1)
    first = after - lengths - 1
    at = np.arange(int(after[-1]) if len(after) else 0) + np.repeat(starts - first, lengths + 1)
    joined = np.append(data, np.uint8(32))[np.minimum(at, len(data))]
    joined[after - 1] = 32
    bounds = np.searchsorted(starts, offsets)
    n_words = np.diff(bounds)
    n_shingles = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    owner = np.repeat(np.arange(len(n_words)), n_shingles)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    begin = bounds[owner] + nth
    end = np.minimum(begin + size, bounds[owner + 1]) - 1
    return joined.tobytes(), owner, first[begin], after[end] - 1


def _majority(raw: bytes, owner: np.ndarray, first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """One fingerprint per text: the bits set in over half of its hashes; 0 without any."""
    sums, counts = np.zeros((n, 64), np.int64), np.bincount(owner, minlength=n)
    of = xxhash.xxh64_intdigest
    # A part at a time, as a hash takes 64 bytes once its bits are spread out.
    for at in range(0, len(owner), HASHES_AT_ONCE):
        ranges = zip(first[at : at + HASHES_AT_ONCE].tolist(), last[at : at + HASHES_AT_ONCE].tolist(), strict=True)
        hashes = np.array([of(raw[a:b], SEED) for a, b in ranges], U64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        texts, begins = np.unique(owner[at : at + HASHES_AT_ONCE], return_index=True)
        sums[texts] += np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
    packed = np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(U64).ravel()


def _fingerprints(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            prints = np.zeros(batch.num_rows, U64)
            for i, j in slices(offsets, 1 << 18):
                part = offsets[i : j + 1]
                prints[i:j] = _majority(*_shingles(data[part[0] : part[-1]], part - part[0], size), j - i)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["row", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, text_column: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(row, fingerprint) per document; ``row`` holds the other columns.

    Shingles of lower-case words are hashed with XXH64; a bit of the fingerprint is set if over
    half of the hashes have it. A text with fewer words is one shingle; without any, or null,
    its fingerprint is 0.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("row")
    sources = docs.select(row, F.col(f"`{text_column}`").alias("text"))
    schema = StructType([sources.schema["row"], StructField("fingerprint", LongType())])
    return sources.mapInArrow(_fingerprints(shingle_words), schema)


def _placed(trees: list[VantageTree], radius: int, parts: dict[tuple[int, int], int]):
    """Each fingerprint as a member of its own leaf and as a query to all leaves in reach.

    The parts of a leaf with many members are tiles of their own: a member belongs to one of
    them, a query goes to all.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.asarray(batch.column(0)).view(U64)
            for at in range(0, len(every), 65536):
                values = every[at : at + 65536]
                tiles, roles, prints = [], [], []
                for t, tree in enumerate(trees):
                    split = np.ones(1 << tree.levels, np.int64)
                    for (tree_number, leaf), n in parts.items():
                        if tree_number == t:
                            split[leaf] = n
                    home = tree.home(values)
                    part = ((values * U64(0x9E3779B97F4A7C15)) >> U64(40)).astype(np.int64) % split[home]
                    which, leaf = tree.visits(values, radius)
                    copies = split[leaf]
                    which, leaf = np.repeat(which, copies), np.repeat(leaf, copies)
                    nth = np.arange(len(which)) - np.repeat(np.cumsum(copies) - copies, copies)
                    tiles += [(t << 56) + (home << 32) + part, (t << 56) + (leaf << 32) + nth]
                    roles += [np.zeros(len(home), np.int8), np.ones(len(which), np.int8)]
                    prints += [values, values[which]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (tiles, roles, [p.view(np.int64) for p in prints])],
                    ["tile", "role", "fingerprint"],
                )

    return run


class _Tile:
    """The members of a tile and which of them are known to be connected."""

    def __init__(self, members: np.ndarray):
        self.members = members
        self.labels = np.arange(len(members))

    def links(self, queries: np.ndarray, apart: int) -> list[tuple[int, int]]:
        """Links that connect all that the queries reach: at most one per query and member."""
        found = []
        step = max(1, (1 << 21) // max(1, len(self.members)))
        for at in range(0, len(queries), step):
            part = queries[at : at + step]
            near = np.bitwise_count(part[:, None] ^ self.members[None, :]) <= apart
            hits = np.count_nonzero(near, axis=1)
            alone = np.flatnonzero(hits == 1)
            member = self.members[near[alone].argmax(axis=1)] if len(alone) else part[:0]
            other = member != part[alone]
            found += zip(part[alone][other].tolist(), member[other].tolist(), strict=True)
            for q in np.flatnonzero(hits > 1):
                reached = np.flatnonzero(near[q])
                labels, first = np.unique(self.labels[reached], return_index=True)
                value = part[q]
                present = bool((self.members[reached] == value).any())
                if len(labels) > 1 or not present:
                    ends = self.members[reached[first]]
                    found += [(int(value), int(e)) for e in ends if e != value]
                    if len(labels) > 1:
                        self.labels[np.isin(self.labels, labels)] = labels[0]
        return found


def _tile_links(apart: int):
    """Rows arrive sorted by tile, members first; queries are streamed past the members."""

    def rows(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        ends = np.array(pairs, U64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tile, gathered = None, None, []
        for batch in batches:
            tiles, roles = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            prints = np.asarray(batch.column(2)).view(U64)
            edges = np.flatnonzero(np.diff(tiles) | np.diff(roles)) + 1
            for a, b in zip([0, *edges], [*edges, len(tiles)], strict=True):
                if a == b:
                    continue
                if tiles[a] != tile:
                    tile, current, gathered = tiles[a], None, []
                if roles[a] == 0:
                    gathered.append(prints[a:b])
                    continue
                if current is None:
                    current = _Tile(np.concatenate(gathered) if gathered else prints[:0])
                if len(current.members):
                    pairs = current.links(prints[a:b], apart)
                    if pairs:
                        yield rows(pairs)

    return run


def linked(prints: DataFrame, max_bits_apart: int = MAX_BITS_APART) -> DataFrame:
    """(a, b): links among the distinct ``fingerprint`` values that connect all that are near.

    Two values that differ in at most ``d`` bits differ in at most one bit of some block when
    the bits are cut into ``d // 2 + 1`` blocks. Each block has a vantage-point tree over the
    Hamming distance in the block. A value is a member of one leaf per tree and queries every
    leaf that the triangle bound does not exclude for a radius of one bit; there it is compared
    with the members over all bits. Links among values that are connected already are left
    out, so their number stays in proportion to the values placed, however dense a leaf is.
    """
    n = prints.count()
    masks = block_masks(64, max_bits_apart // 2 + 1)
    levels = max(0, min(MAX_LEVELS, int(np.ceil(np.log2(max(n, 1) / LEAF_TARGET)))))
    sample = np.array([r[0] for r in prints.select("fingerprint").limit(TREE_SAMPLE).collect()], np.int64).view(U64)
    trees = [VantageTree.fit(sample, mask, levels) for mask in masks]
    radius = 1

    def homes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(0)).view(U64)
            for t, tree in enumerate(trees):
                leaf, count = np.unique(tree.home(values), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(leaf), t)), pa.array(leaf), pa.array(count)], ["tree", "leaf", "n"]
                )

    # At most 2 ** MAX_LEVELS leaves per tree: only those with many members come to the driver.
    crowded = (
        prints.select("fingerprint").mapInArrow(homes, "tree long, leaf long, n long")
        .groupBy("tree", "leaf").agg(F.sum("n").alias("n")).filter(F.col("n") > TILE_MEMBERS)
    )
    parts = {(r["tree"], r["leaf"]): -(-r["n"] // TILE_MEMBERS) for r in crowded.collect()}
    placed = prints.select("fingerprint").mapInArrow(_placed(trees, radius, parts), "tile long, role byte, fingerprint long")
    dealt = placed.repartition("tile").sortWithinPartitions("tile", "role")
    return dealt.mapInArrow(_tile_links(max_bits_apart), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits_apart: int = MAX_BITS_APART,
) -> DataFrame:
    """(row, fingerprint, component_id) per document; ``row`` holds the columns but the text.

    Documents whose fingerprints differ in at most ``max_bits_apart`` bits are linked;
    ``component_id`` is the smallest id that can be reached, the own one included. Equal
    fingerprints are collapsed first, so copies cost one row each.

    Null and empty texts have the fingerprint 0 and are linked like any other. A null id counts
    as smaller than all others; a component whose smallest id is null has a null
    ``component_id``. Rows that share an id are documents of their own. No rows give no rows.
    """
    prints = written(fingerprints(docs, text_column, shingle_words), "fingerprints")
    key = F.coalesce(F.col(f"row.`{id_column}`").cast("long"), F.lit(NULL_ID))
    placed, least = _components(prints, key, max_bits_apart)
    labels = placed.join(least, "root").select("fingerprint", "component")
    component = F.when(F.col("component") != NULL_ID, F.col("component")).alias("component_id")
    return prints.join(labels, "fingerprint").select("row", "fingerprint", component)


def _components(prints: DataFrame, key: Column, max_bits_apart: int) -> tuple[DataFrame, DataFrame]:
    """(fingerprint, least, root), and per root the smallest key, as (root, component)."""
    distinct = written(prints.groupBy("fingerprint").agg(F.min(key).alias("least")), "distinct-fingerprints")
    found = components(linked(distinct, max_bits_apart))
    placed = distinct.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    # Written, so that the rows of a large component can be split in the join.
    placed = written(placed, "placed")
    return placed, written(placed.groupBy("root").agg(F.min("least").alias("component")), "component-ids")


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each component, by the smallest id; the columns stay as they are.

    Of rows that share this id, the one with the smallest SHA-256 of its text stays.
    """
    own = F.sha2(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), 256).alias("_own")
    texts = docs.select(id_key(id_column).alias("_key"), own, F.col(f"`{text_column}`").alias("text"))
    prints = written(fingerprints(texts), "fingerprints")
    placed, _ = _components(prints, F.col("row._key"), MAX_BITS_APART)
    # The smallest of each fingerprint first, so that a component's copies do not come together.
    first = prints.groupBy("fingerprint").agg(F.min("row").alias("row"))
    stay = first.join(placed, "fingerprint").groupBy("root").agg(F.min("row").alias("row")).select("row.*")
    rows = docs.select(whole_row(docs), id_key(id_column).alias("_key"), own)
    # What is left of one id and text are repeated rows.
    return rows.join(written(stay, "staying"), ["_key", "_own"], "left_semi").dropDuplicates(["_key", "_own"]).select("row.*")
