"""A bigram language model by deleted interpolation.

Counts are exchanged in packed form. Documents are put into blocks of about ``BLOCK_BYTES``;
a block sends its distinct keys (64-bit hashes of words and of pairs) with its training counts
to ranges of the key space, sorted and compressed, and gets back the totals in the same order.
So the rows that are shuffled are arrays, a key costs some six bytes per block, and no key is
hot: each block sends it once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatloom.llm.text import LOWER, U64, Rolling, byte_values, mix, owners, slices, text_buffer, words
from flatloom.scratch import written

BLOCK_BYTES = 4 << 20
# Keys, about, whose totals one task adds up at a time.
RANGE_KEYS = 1_000_000
HELD_OUT_REMAINDER, MODULUS = 2, 7
_END = U64(0x2545F4914F6CDD1D)
_PAIR = U64(0xD6E8FEB86659FD93)
# Cells per octave of the ratios on which the mixture weights are fitted.
_STEPS = 4
_NONE = -10_000
EM_ROUNDS = 60


def _packed(values: np.ndarray) -> bytes:
    """Small integers in few bytes: all first bytes, then all second bytes, and so on."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _deltas(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=U64(0))


def held_out(doc_id) -> bool:
    """Whether a document is kept from training: CRC-32 of its id as text; a null id reads as empty."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % MODULUS == HELD_OUT_REMAINDER


_BLOCK = pa.schema(
    [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("texts", pa.binary())]
)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of one task together, ``BLOCK_BYTES`` of text per row."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    ids: list = []
    ends: list[np.ndarray] = []
    parts: list[bytes] = []
    size = 0

    def block() -> pa.RecordBatch:
        raw = zstandard.ZstdCompressor(level=3).compress(b"".join(parts))
        columns = [[number], [ids], [np.concatenate(ends)], [raw]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK, strict=True)], schema=_BLOCK)

    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        for i, j in slices(offsets):
            ids += batch.column(0).slice(i, j - i).to_pylist()
            ends.append(offsets[i + 1 : j + 1] - offsets[i] + size)
            parts.append(data[offsets[i] : offsets[j]].tobytes())
            size += int(offsets[j] - offsets[i])
            if size >= BLOCK_BYTES:
                yield block()
                number, ids, ends, parts, size = number + 1, [], [], [], 0
    if ids:
        yield block()


@dataclass
class _Tokens:
    """A block's tokens in order, each document closed by an end, and their distinct keys."""

    ids: list
    held: np.ndarray
    owner: np.ndarray
    word_keys: np.ndarray
    word: np.ndarray
    pair_keys: np.ndarray
    pair: np.ndarray
    before: np.ndarray


def _tokens(ids: list, ends: np.ndarray, raw: bytes) -> _Tokens:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=max(1, int(ends[-1]))), np.uint8)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    hashes, owner = [], []
    for i, j in slices(offsets):
        part = LOWER[data[offsets[i] : offsets[j]]]
        bounds = offsets[i : j + 1] - offsets[i]
        starts, stops = words(part, bounds)
        values = Rolling(byte_values(part)).ranges(starts, stops)
        of = owners(bounds, starts)
        # Every document gets its end after its words.
        at = np.searchsorted(of, np.arange(j - i), "right")
        hashes.append(np.insert(values, at, _END))
        owner.append(np.insert(of, at, np.arange(j - i)) + i)
    token, owner = np.concatenate(hashes), np.concatenate(owner)
    # The token before the first is an end, as between documents.
    previous = np.concatenate([[_END], token[:-1]])
    word_keys, word = np.unique(token, return_inverse=True)
    pair_keys, pair = np.unique(mix(previous * _PAIR + token), return_inverse=True)
    first = np.searchsorted(word_keys, _END)
    before = np.concatenate([[first], word[:-1]])
    held = np.array([held_out(x) for x in ids])
    return _Tokens(ids, held, owner, word_keys, word, pair_keys, pair, before)


def _rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The rows of a batch one after the other: a row is a whole block, and one is held at a time."""
    columns = [batch.column(n) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def _requests(n_ranges: int):
    """The keys of each block by range, with how often its training documents have them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = (1 << 64) // n_ranges + 1
        edges = np.array([min(width * i, (1 << 64) - 1) for i in range(1, n_ranges)], U64)
        for batch in batches:
            for block, ids, ends, raw in _rows(batch, "block", "ids", "ends", "texts"):
                t = _tokens(ids, np.array(ends, np.int64), raw)
                trained = ~t.held[t.owner]
                columns: list[list] = [[], [], [], [], [], []]
                packs = []
                for keys, of in ((t.word_keys, t.word), (t.pair_keys, t.pair)):
                    counts = np.bincount(of[trained], minlength=len(keys)).astype(U64)
                    cuts = [0, *np.searchsorted(keys, edges, "left"), len(keys)]
                    packs.append([(keys[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
                for r, ((wk, wc), (pk, pc)) in enumerate(zip(*packs, strict=True)):
                    if len(wk) or len(pk):
                        values = (r, block, _packed(_deltas(wk)), _packed(wc), _packed(_deltas(pk)), _packed(pc))
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
                names = ["range", "block", "word_keys", "word_counts", "pair_keys", "pair_counts"]
                for a in range(0, len(columns[0]), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[a : a + 64], k) for c, k in zip(columns, kinds, strict=True)], names
                    )

    return run


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], int, int]:
    """(totals in the order of each input, distinct keys that occur, all occurrences)."""
    if not keys:
        return [], 0, 0
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(where, np.concatenate(counts).astype(np.float64), len(distinct)).astype(U64)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return np.split(totals[where], cuts), int((totals > 0).sum()), int(totals.sum())


_TOTALS = "block long, range long, words binary, pairs binary, n_types long, n_tokens long"


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The totals of a range, back to each block that asked. Rows arrive sorted by range.

    The first row of a range also tells how many word types and tokens training has in it.
    """

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        word_keys = [np.cumsum(_unpacked(r[2]), dtype=U64) for r in rows]
        pair_keys = [np.cumsum(_unpacked(r[4]), dtype=U64) for r in rows]
        of_words, types, tokens = _added(word_keys, [_unpacked(r[3]) for r in rows])
        of_pairs, _, _ = _added(pair_keys, [_unpacked(r[5]) for r in rows])
        columns = [
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([_packed(x) for x in of_words], pa.binary()),
            pa.array([_packed(x) for x in of_pairs], pa.binary()),
            pa.array([types] + [0] * (len(rows) - 1), pa.int64()),
            pa.array([tokens] + [0] * (len(rows) - 1), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "range", "words", "pairs", "n_types", "n_tokens"])

    held: list[tuple] = []
    for batch in batches:
        for row in _rows(batch, *batch.schema.names):
            if held and held[-1][0] != row[0]:
                yield answer(held)
                held = []
            held.append(row)
    if held:
        yield answer(held)


@dataclass
class _Counted:
    """A block's tokens with the corpus totals of their keys."""

    tokens: _Tokens
    words: np.ndarray
    pairs: np.ndarray


def _resolved(batch: pa.RecordBatch) -> Iterator[_Counted]:
    for ids, ends, raw, totals in _rows(batch, "ids", "ends", "texts", "totals"):
        t = _tokens(ids, np.array(ends, np.int64), raw)
        totals = sorted(totals, key=lambda r: r["range"])
        yield _Counted(
            t,
            np.concatenate([_unpacked(r["words"]) for r in totals]).astype(np.float64),
            np.concatenate([_unpacked(r["pairs"]) for r in totals]).astype(np.float64),
        )


def _bucket(count: np.ndarray) -> np.ndarray:
    """The bucket of a context by its frequency: 0 for none, then one per power of two."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0).astype(np.int64)


def _held_out_cells(n_tokens: int, n_types: int):
    """Training tokens by bucket and by the ratios of their estimates, each token left out itself."""

    def cell(ratio: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.where(ratio > 0, np.round(np.log2(ratio) * _STEPS), _NONE).astype(np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _resolved(batch):
                t = c.tokens
                pick = ~t.held[t.owner]
                context = c.words[t.before[pick]] - 1
                pairs = (c.pairs[t.pair[pick]] - 1) / np.maximum(context, 1)
                single = (c.words[t.word[pick]] - 1) / max(1, n_tokens - 1)
                # The three in one number: ratios lie between 2**-64 and 2**64, and _NONE below.
                wide, shift = 1 << 20, 1 << 19
                keys = _bucket(context) * wide + cell(pairs * (n_types + 1)) + shift
                cells, n = np.unique(keys * wide + cell(single * (n_types + 1)) + shift, return_counts=True)
                columns = [cells // wide // wide, cells // wide % wide - shift, cells % wide - shift, n]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["bucket", "pair", "single", "n"])

    return run


def fitted_weights(cells: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (pair, single, uniform) per bucket by expectation-maximisation.

    ``cells`` has rows (bucket, pair cell, single cell, tokens). A bucket without tokens takes
    the weights of the next lower one that has some.
    """
    top = max(65, int(cells[:, 0].max(initial=0)) + 1)
    weights = np.full((top, 3), 1 / 3)
    ratios = np.ones((len(cells), 3))
    for i in (0, 1):
        known = cells[:, i + 1] != _NONE
        ratios[:, i] = np.where(known, np.exp2(np.where(known, cells[:, i + 1], 0) / _STEPS), 0)
    bucket, n = cells[:, 0], cells[:, 3]
    for _ in range(rounds):
        share = weights[bucket] * ratios
        share *= (n / share.sum(axis=1))[:, None]
        for i in range(3):
            weights[:, i] = np.bincount(bucket, share[:, i], top)
        total = weights.sum(axis=1, keepdims=True)
        weights = np.where(total > 0, weights / np.maximum(total, 1e-300), 1 / 3)
    # No text may have probability zero: a trace stays with the uniform part.
    weights = 0.999999 * weights + np.array([0, 0, 0.000001])
    seen = np.bincount(bucket, n, top) > 0
    for b in range(1, top):
        if not seen[b]:
            weights[b] = weights[b - 1]
    return weights


def _scores(n_tokens: int, n_types: int, weights: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _resolved(batch):
                t, n = c.tokens, len(c.tokens.ids)
                count, context = c.words[t.word], c.words[t.before]
                base = np.log10((count + 1) / (n_tokens + n_types + 1))
                w = weights[_bucket(context)]
                pairs = c.pairs[t.pair] / np.maximum(context, 1)
                mixed = w[:, 0] * pairs + w[:, 1] * count / max(1, n_tokens) + w[:, 2] / (n_types + 1)
                columns = [
                    pa.array(t.ids, pa.int64()),
                    pa.array(t.held),
                    pa.array(np.bincount(t.owner, minlength=n)),
                    pa.array(np.bincount(t.owner, count > 0, n).astype(np.int64)),
                    pa.array(np.full(n, n_tokens)),
                    pa.array(np.bincount(t.owner, base, n)),
                    pa.array(np.bincount(t.owner, np.log10(mixed), n)),
                ]
                names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


_SCORE_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def scored(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document scored by a model learned from those that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).
    The base is add-one over single tokens. The model mixes the maximum-likelihood estimates of
    the token after its predecessor, of the token alone, and one over all types and one unknown.
    The weights depend on the frequency of the predecessor, in buckets by powers of two; they
    are learned by expectation-maximisation from all training tokens with each token's own
    occurrence deleted from the counts. For that the tokens are gathered by bucket and rounded
    ratios, a table of bounded size.

    A null or empty text has the end token only. Documents are held out by the CRC-32 of their id
    as text; a null id reads as empty text. Rows that share an id are documents of their own.
    Without training documents all counts are zero and both scores fall back to the uniform
    part. Other columns are left out. No rows give no rows.
    """
    sources = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    blocks = written(sources.mapInArrow(_blocks, "block long, ids array<long>, ends array<long>, texts binary"), "blocks")
    # Over half of a text's tokens are pairs that its block has not had before, at six bytes a token.
    size = blocks.select(F.sum(F.expr("element_at(ends, -1)"))).first()[0] or 0
    n_ranges = max(1, -(-size // 8 // RANGE_KEYS))
    kinds = "range long, block long, word_keys binary, word_counts binary, pair_keys binary, pair_counts binary"
    asked = blocks.mapInArrow(_requests(n_ranges), kinds)
    dealt = asked.repartition("range").sortWithinPartitions("range")
    totals = written(dealt.mapInArrow(_totals, _TOTALS), "totals")
    known = totals.agg(F.sum("n_types").alias("types"), F.sum("n_tokens").alias("tokens")).first()
    n_types, n_tokens = known["types"] or 0, known["tokens"] or 0
    answers = totals.groupBy("block").agg(F.collect_list(F.struct("range", "words", "pairs")).alias("totals"))
    resolved = written(blocks.join(answers, "block").select("ids", "ends", "texts", "totals"), "resolved")
    cells = resolved.mapInArrow(_held_out_cells(n_tokens, n_types), "bucket long, pair long, single long, n long")
    # Buckets times cells of two ratios, whatever the number of documents.
    rows = cells.groupBy("bucket", "pair", "single").agg(F.sum("n").alias("n")).collect()
    weights = fitted_weights(np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4))
    return resolved.mapInArrow(_scores(n_tokens, n_types, weights), _SCORE_SCHEMA)
