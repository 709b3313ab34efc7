"""Personal data: fixed patterns first, then identifiers that stand where such data stands.

A slot is a maximal run of words that hold a digit or an ``@``. Its context patterns are the two
words before it, and the word before with the word after. Slots with an entity of a fixed pattern
are seeds; a pattern whose fillers are mostly known makes its other slots known in turn.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flatloom.llm.text import (
    LOWER, U64, Rolling, byte_values, id_key, mix, owners, slices, text_buffer, words
)
from flatloom.scratch import written

KINDS = ("email", "ip", "card", "phone")
# A pattern counts if this many thousandths of its distinct fillers are known, and as many of them as MIN_KNOWN.
PATTERN_MIN, MIN_KNOWN = 800, 3
# An unseen slot text is taken if its best pattern's share, times the share of its patterns that count, reaches this.
INSTANCE_MIN = 400
ROUNDS = 3
# Bits of the filter for each class of patterns that are worth counting; a fixed size, whatever the number of patterns.
FILTER_BITS = 1 << 23

_BITMAP_BITS = 32768
_CLASSES = 16
_EDGES = b"\"'`()[]{}<>,;:.!?"
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match never begins inside a run of digits: where the whole run does not fit, no part of it does.
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT_OR_AT = np.zeros(256, bool)
_DIGIT_OR_AT[[*range(48, 58), 64]] = True
_LOCAL = np.zeros(256, bool)
_LOCAL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")] = True
# Stand for the neighbours that the first and last word of a text do not have.
_BEGIN, _END = U64(0x51ED270B0B1F3C5D), U64(0x2545F4914F6CDD1D)

_SPAN = "array<struct<start: long, kind: int, end: long>>"
_SLOTS = "array<struct<start: long, end: long, kinds: int, instance: long, before: long, around: long>>"


def _emails(text: bytes) -> Iterator[tuple[int, int]]:
    """Found from each ``@`` outwards, so that long runs of letters cost nothing twice."""
    done, at = 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > done and _LOCAL[text[start - 1]]:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find(b"@", max(at + 1, done))


def _digits(text: bytes) -> bytes:
    return bytes(c for c in text if 48 <= c <= 57)


def passes_luhn(digits: bytes) -> bool:
    odd = sum(c - 48 for c in digits[::-2])
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[c - 48] for c in digits[-2::-2])) % 10 == 0


def _is_ip(text: bytes) -> bool:
    parts = [p.lstrip(b"0") for p in text.split(b".")]
    return all(len(p) <= 3 and int(p or b"0") <= 255 for p in parts)


def entities(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns in UTF-8 bytes; leftmost, none overlapping of its own kind."""
    found = [(a, 0, b) for a, b in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _is_ip(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and passes_luhn(digits):
                found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found)


class _Words:
    """The words of some texts, with the hashes of their contexts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends = words(data, offsets)
        self.owner = owners(offsets, self.starts)
        marks = np.concatenate([[0], np.cumsum(_DIGIT_OR_AT[data])])
        self.marked = marks[self.ends] > marks[self.starts]
        self.hashes = Rolling(byte_values(LOWER[data])).ranges(self.starts, self.ends) if len(self.starts) else np.zeros(0, U64)

    def neighbours(self, at: np.ndarray, step: int) -> np.ndarray:
        """The hash of the word ``step`` places on, or of the end of the text."""
        to = at + step
        inside = (to >= 0) & (to < len(self.hashes))
        inside[inside] = self.owner[to[inside]] == self.owner[at[inside]]
        out = np.full(len(at), _END if step > 0 else _BEGIN, U64)
        out[inside] = self.hashes[to[inside]]
        return out

    def patterns(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the two contexts of each run of words from ``first`` to ``last``."""
        left = self.neighbours(first, -1)
        before = mix(mix(self.neighbours(first, -2)) + left)
        around = mix(mix(left + U64(1)) ^ self.neighbours(last, 1))
        return before.view(np.int64), around.view(np.int64)

    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of each run of marked words of one text."""
        new = self.marked.copy()
        new[1:] &= ~(self.marked[:-1] & (self.owner[1:] == self.owner[:-1]))
        last = self.marked.copy()
        last[:-1] &= ~(self.marked[1:] & (self.owner[1:] == self.owner[:-1]))
        return np.flatnonzero(new), np.flatnonzero(last)


def _overlaps(begins: list[int], ends: list[int], start: int, end: int) -> bool:
    """Whether any of some sorted ranges, which do not overlap each other, overlaps a range."""
    last = bisect_left(begins, end) - 1
    return last >= 0 and ends[last] > start


def _found_in(data: np.ndarray, offsets: np.ndarray) -> tuple[list, list]:
    """(entities, slots) of each text, in code points."""
    n = len(offsets) - 1
    spans: list[list] = [[] for _ in range(n)]
    slots: list[list] = [[] for _ in range(n)]
    known = _Words(data, offsets)
    first, last = known.slots()
    before, around = known.patterns(first, last)
    holder = known.owner[first]
    for i in np.unique(holder).tolist():
        a, b = int(offsets[i]), int(offsets[i + 1])
        text = data[a:b].tobytes()
        points = np.concatenate([[0], np.cumsum((data[a:b] & 0xC0) != 0x80)]).tolist()
        own = entities(text)
        by_kind = [([s for s, k, _ in own if k == kind], [e for _, k, e in own if k == kind]) for kind in range(len(KINDS))]
        spans[i] = [{"start": points[s], "kind": k, "end": points[e]} for s, k, e in own]
        for j in np.flatnonzero(holder == i).tolist() if n > 1 else range(len(first)):
            s, e = int(known.starts[first[j]]) - a, int(known.ends[last[j]]) - a
            part = text[s:e]
            s += len(part) - len(part.lstrip(_EDGES))
            part = part.strip(_EDGES)
            e = s + len(part)
            kinds = sum(1 << k for k, (begins, ends) in enumerate(by_kind) if _overlaps(begins, ends, s, e))
            instance = np.array(xxhash.xxh64_intdigest(part), U64).view(np.int64).item()
            slots[i].append({
                "start": points[s], "end": points[e], "kinds": kinds, "instance": instance,
                "before": int(before[j]), "around": int(around[j]),
            })
    return spans, slots


def _first_pass(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    longs = [(c, pa.int64()) for c in ("instance", "before", "around")]
    slot = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kinds", pa.int32()), *longs]))
    for batch in batches:
        data, offsets = text_buffer(batch.column(batch.num_columns - 1))
        spans: list[list] = []
        slots: list[list] = []
        for i, j in slices(offsets):
            found = _found_in(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            spans += found[0]
            slots += found[1]
        columns = [batch.column(k) for k in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(spans, span), pa.array(slots, slot)], [*batch.schema.names[:-1], "base", "slots"]
        )


def _other_fillers(classes: dict[int, bytes]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(pattern, filler) of words that are no slot, at the patterns that the filter lets through.

    Of a pattern of class ``c`` a batch gives ``_enough(c)`` distinct fillers at most: with so many
    the pattern cannot reach ``PATTERN_MIN`` any more, whatever else it holds.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [(np.frombuffer(bits, np.uint8), _enough(c)) for c, bits in sorted(classes.items())]
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            found: list[tuple[np.ndarray, ...]] = []
            for i, j in slices(offsets):
                known = _Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                plain = np.flatnonzero(~known.marked)
                for pattern in known.patterns(plain, plain):
                    place = pattern.view(U64) % U64(FILTER_BITS)
                    most = np.zeros(len(plain), np.int64)
                    for bits, enough in filters:
                        hit = (bits[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1
                        most[hit] = enough
                    hit = most > 0
                    found.append((pattern[hit], known.hashes[plain[hit]].view(np.int64), most[hit]))
            if not found:
                continue
            pattern, filler, most = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((filler, pattern))
            pattern, filler, most = pattern[order], filler[order], most[order]
            new = np.ones(len(pattern), bool)
            new[1:] = (pattern[1:] != pattern[:-1]) | (filler[1:] != filler[:-1])
            pattern, filler, most = pattern[new], filler[new], most[new]
            keep = np.arange(len(pattern)) - np.searchsorted(pattern, pattern) < most
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(pattern[keep]), pa.array(filler[keep])], ["pattern", "filler"])

    return run


def _enough(size_class: int) -> int:
    """More than a quarter of the slots of any pattern of this class; no bound for the last class."""
    return MIN_KNOWN * 4**size_class + 1 if size_class < _CLASSES - 1 else 1 << 62


def _filter(patterns: DataFrame) -> dict[int, bytes]:
    """For each class of patterns by their number of slots, a bit for each pattern by its hash.

    Class ``c`` has ``MIN_KNOWN * 4**c`` slots and up. Every class has ``FILTER_BITS`` bits, put together by Spark.
    """
    place = F.pmod(F.col("pattern"), F.lit(FILTER_BITS))
    bounds = [F.when(F.col("n_slots") >= MIN_KNOWN * 4**c, F.lit(c)) for c in reversed(range(_CLASSES))]
    parts = patterns.groupBy(F.coalesce(*bounds).alias("class"), F.floor(place / _BITMAP_BITS).alias("part")).agg(
        F.bitmap_construct_agg(place % _BITMAP_BITS).alias("bits")
    )
    out: dict[int, bytearray] = {}
    for r in parts.collect():  # at most _CLASSES * FILTER_BITS / 32768 rows of 4 KB
        at = r["part"] * (_BITMAP_BITS // 8)
        out.setdefault(r["class"], bytearray(FILTER_BITS // 8))[at : at + _BITMAP_BITS // 8] = r["bits"]
    return {c: bytes(bits) for c, bits in out.items()}


def _known_instances(slots: DataFrame, texts: DataFrame, rounds: int) -> DataFrame:
    """(instance, kind) of the slot texts that no fixed pattern knows and that the contexts give away.

    The graph's edges join patterns to the slot texts they hold. In each round a pattern is scored
    by the share of its distinct fillers that are known to be of a kind, words that are no slot
    included; slot texts are scored by their best pattern and the share of their patterns that
    count, and become known. Other fillers are counted exactly as long as the pattern can still count. Scores are whole thousandths, so that no order of adding matters.
    """
    both = slots.select("instance", "kinds", F.explode(F.array("before", "around")).alias("pattern"))
    edges = written(both.groupBy("pattern", "instance").agg(F.bit_or("kinds").alias("kinds")), "edges")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n_slots")).filter(F.col("n_slots") >= MIN_KNOWN)
    sizes = written(sizes, "patterns")
    others = texts.mapInArrow(_other_fillers(_filter(sizes)), "pattern long, filler long").distinct()
    others = others.groupBy("pattern").agg(F.count("*").alias("n_others"))
    totals = sizes.join(others, "pattern", "left")
    totals = written(totals.select("pattern", (F.col("n_slots") + F.coalesce("n_others", F.lit(0))).alias("n_all")), "fillers")
    edges = written(edges.join(totals, "pattern"), "graph")
    degrees = edges.groupBy("instance").agg(F.count("*").alias("degree"), F.bit_or("kinds").alias("kinds"))
    kinds = F.filter(F.array(*(F.when(F.shiftright("kinds", k).bitwiseAND(1) == 1, F.lit(k)) for k in range(len(KINDS)))), lambda x: x.isNotNull())
    seeds = written(degrees.filter("kinds > 0").select("instance", F.explode(kinds).alias("kind"), F.lit(1000).cast("long").alias("score")), "seeds")
    unseen = written(degrees.filter("kinds = 0").select("instance", "degree"), "unseen")
    known, before = seeds, -1
    found = seeds.limit(0)
    for _ in range(rounds):
        masses = edges.join(known, "instance").groupBy("pattern", "kind", "n_all").agg(
            F.sum("score").alias("mass"), F.count("*").alias("n_known")
        )
        share = F.floor(F.col("mass") / F.col("n_all")).alias("share")
        good = masses.filter(F.col("n_known") >= MIN_KNOWN).select("pattern", "kind", share)
        good = written(good.filter(F.col("share") >= PATTERN_MIN), "good-patterns")
        votes = edges.join(good, "pattern").groupBy("instance", "kind").agg(
            F.max("share").alias("best"), F.count("*").alias("votes")
        )
        scored = votes.join(unseen, "instance")
        score = F.floor(F.col("best") * F.col("votes") / F.col("degree")).alias("score")
        best = scored.select("instance", score, "kind").filter(F.col("score") >= INSTANCE_MIN)
        best = best.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
        found = written(best.select("instance", (-F.col("b.k")).alias("kind"), F.col("b.score").alias("score")), "found")
        now = found.count()
        if now == before or now == 0:
            break
        known, before = seeds.unionByName(found), now
    return found.select("instance", "kind")


def number_of(kind: int) -> Column:
    """How many entities of a kind the fixed patterns find."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind))


def _as_text(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"]))
    return F.concat_ws(",", parts)


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """The personal data of every document: row (all columns but the text), base and spans (arrays of
    start, kind number and end in code points, sorted), base_text and spans_text (``kind:start:end``).

    ``base`` holds the entities of the fixed patterns; ``spans`` has these and the slots, without the
    punctuation around them, that contexts give away, under the kind of the seeds they stand for. A slot
    that overlaps an entity is never added. A null or empty text has no spans. Texts are read whole.
    Null and repeated ids keep their rows apart by their texts; rows equal in both have equal
    spans. Equal slot texts, however often they come, are one instance; several kinds with the
    same score go to the first in ``KINDS``. Without seeds nothing is added. No rows give no rows.

    The texts are read twice: for entities and slots, then for the other words that stand in
    the contexts of slots. Words and contexts are told apart by 64-bit hashes. What is shuffled are contexts of
    slots, their distinct fillers, and slots of texts that were found; no text.
    """
    others = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != text_column))
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    prepared = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in others.columns)).alias("row"),
        id_key(id_column).alias("_id"), F.xxhash64(text).alias("_content"), F.octet_length(text).alias("_size"), text.alias("_text"),
    )
    spans = StructType.fromDDL(f"base {_SPAN}, slots {_SLOTS}")
    schema = StructType([*(prepared.schema[c] for c in ("row", "_id", "_content", "_size")), *spans])
    first = written(prepared.mapInArrow(_first_pass, schema), "entities-and-slots")
    own = ["_id", "_content", "_size"]
    slots = first.select(*own, F.explode("slots").alias("slot")).select(*own, "slot.*")
    known = written(_known_instances(slots, docs.select(text.alias("_text")), rounds), "known")
    unseen = written(slots.filter("kinds = 0").distinct(), "unseen-slots")
    span = F.struct("start", "kind", "end")
    # A document's own slots only.
    added = unseen.join(known, "instance").groupBy(*own).agg(F.collect_set(span).alias("added"))
    added = written(added, "added")
    out = first.drop("slots").join(added, own, "left").select(
        "row", "base", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(_SPAN)))).alias("spans")
    )
    return out.select("row", "base", "spans", _as_text(F.col("base")).alias("base_text"), _as_text(F.col("spans")).alias("spans_text"))
