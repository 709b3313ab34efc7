"""SentencePiece encoding and decoding by matching all pieces in a suffix array."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from flatloom.llm.piece_table import SPACE_MARK, PieceTable, merged, piece_table
from flatloom.llm.suffixes import suffix_order
from flatloom.llm.text import slices, text_buffer

# Bytes of text whose new words are indexed together.
BATCH_BYTES = 4 << 20
# Words whose ids a task remembers; it then forgets them all and starts anew.
REMEMBERED_WORDS = 500_000


class _Matcher:
    """Finds all occurrences of all pieces in a text of code points."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.lengths = np.array([len(p) for p in table.pieces])
        self.depth = int(self.lengths.max())
        points = np.zeros((len(table.pieces), self.depth), np.int64)
        for i, p in enumerate(table.pieces):
            points[i, : len(p)] = [ord(c) for c in p]
        self._points = points
        self.matchable = table.usable[:-1]

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every occurrence; ``text`` has code points and 0 as separator."""
        alphabet = np.unique(text)
        symbols = np.searchsorted(alphabet, text)
        spot = np.minimum(np.searchsorted(alphabet, self._points), len(alphabet) - 1)
        known = (alphabet[spot] == self._points) & (self._points > 0)
        inside = np.arange(self.depth) < self.lengths[:, None]
        pieces = np.flatnonzero(self.matchable & (known | ~inside).all(axis=1))
        wanted = np.where(inside, spot, 0)[pieces]
        rows = suffix_order(symbols, self.depth).rows
        low = self._bound(symbols, rows, wanted, self.lengths[pieces], False)
        high = self._bound(symbols, rows, wanted, self.lengths[pieces], True)
        n = high - low
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return rows[at], np.repeat(pieces, n)

    def _bound(self, text: np.ndarray, rows: np.ndarray, wanted: np.ndarray, lengths: np.ndarray, above: bool) -> np.ndarray:
        """For each piece, the first row whose beginning is not below it, or that is above it."""
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(rows))
        while (active := np.flatnonzero(low < high)).size:
            middle = (low[active] + high[active]) // 2
            order = self._compared(text, rows[middle], wanted[active], lengths[active])
            go_right = order <= 0 if above else order < 0
            low[active[go_right]] = middle[go_right] + 1
            high[active[~go_right]] = middle[~go_right]
        return low

    def _compared(self, text: np.ndarray, at: np.ndarray, wanted: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the beginning of each suffix is below, equal to or above the piece."""
        order = np.zeros(len(at), np.int64)
        open_ = np.arange(len(at))
        for i in range(self.depth):
            open_ = open_[lengths[open_] > i]
            if not len(open_):
                break
            place = at[open_] + i
            symbol = np.where(place < len(text), text[np.minimum(place, len(text) - 1)], -1)
            order[open_] = np.sign(symbol - wanted[open_, i])
            open_ = open_[order[open_] == 0]
        return order


def _relaxed(table: PieceTable, text: np.ndarray, start: np.ndarray, piece: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each place of the text, the piece that ends before it on the way from its word's start.

    ``text`` holds words, each after a separator 0. Edges are taken in the order of where they
    end. A place is reached by one piece only: the one that may follow the piece that reaches
    its start. A character without a piece is an edge of its own.
    """
    n, none = len(text), len(table.ids)
    covered = np.zeros(n, bool)
    covered[start[lengths[piece] == 1]] = True
    alone = np.flatnonzero(~covered & (text != 0))
    start = np.concatenate([start, alone])
    end = np.concatenate([start[: len(piece)] + lengths[piece], alone + 1])
    piece = np.concatenate([piece, np.full(len(alone), none)])
    word = np.maximum.accumulate(np.where(text == 0, np.arange(n), 0))
    step = end - word[start] - 1
    # Small integers are sorted by their digits.
    order = np.argsort(step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step, kind="stable")
    start, end, piece, step = start[order], end[order], piece[order], step[order]
    reached = np.full(n + 1, -1)
    cuts = np.searchsorted(step, np.arange(1, int(step.max(initial=0)) + 2))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        s, p = start[a:b], piece[a:b]
        first = text[s - 1] == 0
        good = first.copy()
        rest = np.flatnonzero(~first & (reached[s] >= 0))
        if len(rest):
            keys, where = np.unique(reached[s[rest]] * (none + 1) + p[rest], return_inverse=True)
            good[rest] = table.compatible(keys // (none + 1), keys % (none + 1))[where]
        reached[end[a:b][good]] = p[good]
    return reached


class _Numbers(dict):
    """Numbers its keys from 0 as they are asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Encoder:
    """Ids of texts, by words: a space mark and what follows up to the next space."""

    def __init__(self, path: str):
        self.table = piece_table(path)
        self._matcher = _Matcher(self.table)
        self._forget()

    def _ids(self, piece: int, character: str) -> list[int]:
        """The ids of a piece, or those of a character without one: its bytes."""
        if piece < len(self.table.ids):
            return [int(self.table.ids[piece])]
        return self.table.byte_ids[np.frombuffer(character.encode(), np.uint8)].tolist()

    def _merged(self, word: str) -> list[int]:
        """Ids by merging in order; for runs of spaces, in which equal ranks compete."""
        ends = {i: i + 1 for i in range(len(word))}
        for a, middle, b, _ in merged(list(word), self.table.ranks):
            ends[a] = b
            del ends[middle]
        out: list[int] = []
        number = self._number()
        for a in sorted(ends):
            out += self._ids(number.get(word[a : ends[a]], len(self.table.ids)), word[a : ends[a]])
        return out

    def _number(self) -> dict[str, int]:
        if not hasattr(self, "_numbers"):
            self._numbers = {p: i for i, p in enumerate(self.table.pieces)}
        return self._numbers

    def words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        out: list[list[int] | None] = [None] * len(words)
        plain = []
        for i, word in enumerate(words):
            if 2 * SPACE_MARK in word or "\0" in word:
                out[i] = self._merged(word)
            else:
                plain.append(i)
        if plain:
            joined = "\0" + "\0".join(words[i] for i in plain) + "\0"
            text = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            start, piece = self._matcher.edges(text)
            lengths = np.append(self._matcher.lengths, 1)
            reached = _relaxed(self.table, text, start, piece, lengths)
            stops = np.flatnonzero(text == 0)
            # From the end of each word back to its start, all words in step.
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            number, at = np.arange(len(plain)), stops[1:].copy()
            live = at > stops[:-1] + 1
            number, at = number[live], at[live]
            while len(at):
                p = reached[at]
                at = at - lengths[p]
                found.append((number, at, p))
                more = text[at - 1] != 0
                number, at = number[more], at[more]
            for i in plain:
                out[i] = []
            if found:
                number, at, p = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(at)
                none = len(self.table.ids)
                ids = np.append(self.table.ids, -1)[p[order]].tolist()
                for n, a, token in zip(number[order].tolist(), at[order].tolist(), ids, strict=True):
                    out[plain[n]] += [token] if token >= 0 else self._ids(none, joined[a])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; an empty text has none.

        Words are known by what follows their first space mark, and are encoded once as long
        as they are remembered.
        """
        if len(self._words) > REMEMBERED_WORDS:
            self._forget()
        lists = [self._cut(text) for text in texts]
        new = list(self._words)[len(self._sizes) :]
        if new:
            ids = self.words([SPACE_MARK + word for word in new])
            self._sizes = np.concatenate([self._sizes, np.array([len(x) for x in ids], np.int64)])
            self._flat = np.concatenate([self._flat, np.array([t for x in ids for t in x], np.uint32)])
        begins = np.cumsum(self._sizes) - self._sizes
        out = []
        for numbers in lists:
            own = np.array(numbers, np.int64)
            n = self._sizes[own]
            total = int(n.sum())
            out.append(self._flat[np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins[own], n)])
        return out

    def _forget(self) -> None:
        self._words, self._sizes, self._flat = _Numbers(), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _cut(self, text: str) -> list[int]:
        """The numbers of a text's words."""
        if not text:
            return []
        cut = text.replace(SPACE_MARK, " ").split(" ")
        if "" not in cut:
            return list(map(self._words.__getitem__, cut))
        # Spaces that follow one another belong to the next word, or are one at the end.
        own, marks = [], ""
        for i, word in enumerate(cut):
            if word or i == len(cut) - 1:
                own.append(self._words[marks + word])
                marks = ""
            else:
                marks += SPACE_MARK
        return own


class Decoder:
    """Text of ids: the pieces one after the other, byte pieces as bytes, without the first space."""

    def __init__(self, path: str):
        table = piece_table(path)
        self._bytes: dict[int, bytes] = {int(i): p.replace(SPACE_MARK, " ").encode() for i, p in zip(table.ids, table.pieces, strict=True)}
        self._bytes |= {int(i): bytes([b]) for b, i in enumerate(table.byte_ids) if i != table.unknown_id}
        self._bytes[table.unknown_id] = " ⁇ ".encode()

    def decode(self, ids: Iterable[int]) -> str:
        """Control pieces are left out; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(self._bytes.get(i, b"") for i in ids).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _encode(path: str, with_ids: bool, check: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(path), Decoder(path)
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for i, j in slices(offsets, BATCH_BYTES):
                texts = batch.column(1).slice(i, j - i).to_pylist()
                ids = encoder.encode([t or "" for t in texts])
                columns = [
                    batch.column(0).slice(i, j - i),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                ]
                names = ["row", "n_pieces", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                if check:
                    decoded = [decoder.decode(x.tolist()) for x in ids]
                    columns.append(pa.array([zlib.crc32(t.encode()) for t in decoded], pa.int64()))
                    names.append("decoded_crc32")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encoded(
    docs: DataFrame, model_path: str, text_column: str = "text", with_ids: bool = True, decode: bool = False
) -> DataFrame:
    """(row, n_pieces, ids_crc32[, ids][, decoded_crc32]) per document; ``row`` holds the other columns.

    The distinct new words of a few megabytes of text are joined and their suffixes sorted; every
    piece of the model finds its occurrences as a range of the suffixes by binary search. The
    occurrences, sorted by where they end, are relaxed: a piece reaches its end if it may follow
    the piece that reaches its start. For a byte-pair model that gives the one segmentation that
    its merges give. With ``decode`` the ids are also turned back into text.

    A null or empty text has no pieces. A character without a piece becomes its bytes. Texts of
    any length are encoded whole. Rows are independent, so ids, ties and repeated rows do not
    matter; no rows give no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("row")
    sources = docs.select(row, F.col(f"`{text_column}`").alias("text"))
    fields = [sources.schema["row"], StructField("n_pieces", LongType()), StructField("ids_crc32", LongType())]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))
    if decode:
        fields.append(StructField("decoded_crc32", LongType()))
    return sources.mapInArrow(_encode(model_path, with_ids, decode), StructType(fields))


def decoded(rows: DataFrame, model_path: str, ids_column: str = "ids") -> DataFrame:
    """(row, text): the text of a column of ids; null ids give a null text."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != ids_column]).alias("row")
    sources = rows.select(row, F.col(f"`{ids_column}`").alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model_path)
        for batch in batches:
            texts = [None if x is None else decoder.decode(i for i in x if i is not None) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    return sources.mapInArrow(run, StructType([sources.schema["row"], StructField("text", StringType())]))
