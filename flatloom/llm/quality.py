"""Quality rules as a cascade that stops at the first rejection, cheapest rejections first."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from flatloom.llm.text import (
    SPACE,
    Rolling,
    counted,
    item_hashes,
    mix,
    owners,
    runs,
    slices,
    text_buffer,
    words,
)

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
REPEAT_WINDOW = 3
# Documents, and bytes of each, at most, on which cost and selectivity of the rules are estimated.
SAMPLE_ROWS = 500
SAMPLE_BYTES = 1 << 16


class Texts:
    """Some texts, with the measures of the rules, each computed when first asked for.

    ``of(name)`` gives a measure for all texts of this object; a cascade narrows the object to
    the texts that are still in.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        self._known: dict[str, np.ndarray] = {}
        self._spans: tuple[np.ndarray, np.ndarray] | None = None

    def of(self, name: str) -> np.ndarray:
        if name not in self._known:
            self._known[name] = getattr(self, f"_{name}")()
        return self._known[name]

    def narrowed(self, keep: np.ndarray) -> Texts:
        """The texts marked in ``keep``, without what is known about the words of the others."""
        lengths = np.diff(self.offsets)
        part = Texts(self.data[np.repeat(keep, lengths)], np.concatenate([[0], np.cumsum(lengths[keep])]))
        part._known = {name: values[keep] for name, values in self._known.items()}
        return part

    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        if self._spans is None:
            self._spans = words(self.data, self.offsets)
        return self._spans

    def _n_words(self) -> np.ndarray:
        return np.diff(np.searchsorted(self._words()[0], self.offsets))

    def _word_chars(self) -> np.ndarray:
        # A code point has one byte that does not continue another.
        counts = ~SPACE[self.data] & ((self.data & 0xC0) != 0x80)
        return np.diff(np.concatenate([[0], np.cumsum(counts)])[self.offsets])

    def _n_symbols(self) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(SYMBOLS[self.data])])[self.offsets])

    def _n_dup_lines(self) -> np.ndarray:
        starts, ends = runs(self.data != 10, self.offsets)
        inside = np.concatenate([[0], np.cumsum(~SPACE[self.data])])
        filled = inside[ends] > inside[starts]
        starts, ends = starts[filled], ends[filled]
        owner = owners(self.offsets, starts)
        repeated = _after_first(owner, item_hashes(self.data, starts, ends))
        return counted(owner[repeated], self.n)

    def _n_repeat_words(self) -> np.ndarray:
        starts, ends = self._words()
        owner = owners(self.offsets, starts)
        values = item_hashes(self.data, starts, ends)
        size = REPEAT_WINDOW
        covered = np.zeros(len(starts), bool)
        if len(starts) >= size:
            at = np.flatnonzero(owner[size - 1 :] == owner[: len(owner) - size + 1])
            twice = at[_more_than_once(owner[at], Rolling(values).ranges(at, at + size))]
            for i in range(size):
                covered[twice + i] = True
        return counted(owner[covered], self.n)


def _grouped(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stable order, where a new (text, hash) begins in it)."""
    keys = mix(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    return order, new


def _after_first(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Items equal to an earlier one of the same text."""
    order, new = _grouped(owner, hashes)
    return order[~new]


def _more_than_once(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Items that their text has twice or more."""
    order, new = _grouped(owner, hashes)
    single = new & np.append(new[1:], True) if len(new) else new
    return order[~single]


@dataclass(frozen=True)
class Rule:
    """A named test; ``passes`` says which texts it lets through."""

    name: str
    passes: Callable[[Texts], np.ndarray]


# The first two are the base rules. The others reject what no prose looks like; a text without
# words falls to the first rule.
RULES = (
    Rule("too_few_words", lambda t: t.of("n_words") >= 50),
    Rule("repeated_windows", lambda t: 100 * t.of("n_repeat_words") <= 50 * t.of("n_words")),
    Rule(
        "word_length",
        lambda t: (t.of("word_chars") >= 2 * t.of("n_words")) & (t.of("word_chars") <= 20 * t.of("n_words")),
    ),
    Rule("symbols", lambda t: 10 * t.of("n_symbols") <= 3 * t.of("n_words")),
    Rule("duplicate_lines", lambda t: 10 * t.of("n_dup_lines") <= t.of("n_words")),
)
BASE = ("too_few_words", "repeated_windows")


def _batches(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    data, offsets = text_buffer(column)
    for i, j in slices(offsets):
        part = offsets[i : j + 1]
        yield i, j, Texts(data[part[0] : part[-1]], part - part[0])


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> list[dict]:
    """(name, seconds per byte, share of texts rejected) per rule, on a sample of bounded size.

    The sample is the first ``SAMPLE_ROWS`` texts of at most ``SAMPLE_BYTES``, for which Spark reads
    as few files as it needs; it is judged here on the driver. Every rule is timed alone, from
    nothing known. Only the order of the rules depends on it.
    """
    text = F.col(f"`{text_column}`").alias("text")
    short = docs.select(text).filter(F.octet_length("text") <= SAMPLE_BYTES)
    sample = pa.array([r[0] for r in short.limit(SAMPLE_ROWS).collect()], pa.string())
    spent, out, size = [0.0] * len(rules), [0] * len(rules), 0
    for _, _, texts in _batches(sample):
        size += len(texts.data)
        for number, rule in enumerate(rules):
            fresh = Texts(texts.data, texts.offsets)
            start = time.perf_counter()
            out[number] += int((~rule.passes(fresh)).sum())
            spent[number] += time.perf_counter() - start
    return [
        {"name": rule.name, "cost": s / max(1, size), "rejects": n / max(1, len(sample))}
        for rule, s, n in zip(rules, spent, out, strict=True)
    ]


def ordered(rules: tuple[Rule, ...], estimates: list[dict]) -> tuple[Rule, ...]:
    """The rules by rejections per cost, most first; the order among equals stays."""
    worth = {e["name"]: e["rejects"] / max(e["cost"], 1e-12) for e in estimates}
    return tuple(sorted(rules, key=lambda rule: -worth[rule.name]))


def _cascade(texts: Texts, rules: tuple[Rule, ...]) -> np.ndarray:
    """The number of the rule that rejects each text, -1 if none; later rules see only what is left."""
    verdict = np.full(texts.n, -1)
    left, where = texts, np.arange(texts.n)
    for number, rule in enumerate(rules):
        if not left.n:
            break
        good = rule.passes(left)
        if not good.all():
            verdict[where[~good]] = number
            left, where = left.narrowed(good), where[good]
    return verdict


def judged(
    docs: DataFrame,
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
    measures: tuple[str, ...] = (),
    with_text: bool = False,
) -> DataFrame:
    """(row, kept, rejected_by, *measures) per document; ``row`` holds the other columns.

    With ``with_text`` the text is among them.

    ``rejected_by`` names the rule that stopped the cascade, null if none did. Rules are ordered
    by rejections per cost as estimated on a sample of at most ``SAMPLE_ROWS`` texts; a document
    is kept if it passes them all, so the order does not change who is kept. ``measures`` asks
    for figures of every text, also of those that a cheaper rule has rejected.

    A null or empty text has no words and is rejected by the first rule. Rows are judged one by
    one, so ids, repeated rows and ties do not matter; no rows give no rows.
    """
    best = ordered(rules, estimate(docs, rules, text_column))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if with_text or c != text_column]).alias("row")
    # The text is sent once: as a column of its own, or inside the row.
    sources = docs.select(row) if with_text else docs.select(row, F.col(f"`{text_column}`").alias("text"))
    place = docs.columns.index(text_column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).flatten()[place] if with_text else batch.column(1)
            for i, j, texts in _batches(own):
                verdict = _cascade(texts, best)
                names = pa.array([best[v].name if v >= 0 else None for v in verdict], pa.string())
                columns = [batch.column(0).slice(i, j - i), pa.array(verdict < 0), names]
                columns += [pa.array(texts.of(m).astype(np.int64)) for m in measures]
                yield pa.RecordBatch.from_arrays(columns, ["row", "kept", "rejected_by", *measures])

    fields = [StructField("kept", BooleanType()), StructField("rejected_by", StringType())]
    fields += [StructField(m, LongType()) for m in measures]
    return sources.mapInArrow(run, StructType([sources.schema["row"], *fields]))


def kept_documents(docs: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass all rules; the columns stay as they are."""
    return judged(docs, text_column, rules, with_text=True).filter("kept").select("row.*")
