"""The pieces of a byte-pair model, and which two pieces may stand side by side."""

from __future__ import annotations

import functools
import heapq
from dataclasses import dataclass

import numpy as np

SPACE_MARK = "▁"


def merged(symbols: list[str], ranks: dict[str, int]) -> list[tuple[int, int, int, int]]:
    """The merges, in order, of a text given as single characters: (start, middle, end, rank).

    Always the pair with the lowest rank is merged, the leftmost on a tie.
    """
    n = len(symbols)
    after, before, text = list(range(1, n + 1)), list(range(-1, n - 1)), list(symbols)
    heap: list[tuple[int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            whole = text[i] + text[after[i]]
            if whole in ranks:
                heapq.heappush(heap, (ranks[whole], i, whole))

    for i in range(n):
        offer(i)
    done = []
    while heap:
        rank, i, whole = heapq.heappop(heap)
        if text[i] is None or after[i] >= n or text[i] + text[after[i]] != whole:
            continue
        right = after[i]
        done.append((i, right, after[right], rank))
        text[i], text[right] = whole, None
        after[i] = after[right]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return done


@dataclass
class PieceTable:
    """Normal pieces by their ids, numbered 0 to ``n - 1`` here; ``n`` stands for a character
    without a piece.

    ``left`` and ``right`` are the parts that a piece was merged from, -1 for a single
    character; ``usable`` says whether a piece is what its own text becomes.
    """

    ids: np.ndarray
    pieces: list[str]
    ranks: dict[str, int]
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    usable: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    byte_ids: np.ndarray
    unknown_id: int

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the text of two pieces, each merged by itself, stays two pieces.

        The merges next to the border are undone from the last to the first. A pair across the
        border must not have been due before the merge that used up one of its sides.
        """
        n = len(self.ids)
        ok = np.ones(len(first), bool)
        live = np.flatnonzero((first < n) & (second < n))
        a, b = first[live].copy(), second[live].copy()
        due = np.full(len(live), np.iinfo(np.int64).max)
        while len(live):
            keys = a * (n + 1) + b
            spot = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            clash = (self.pair_keys[spot] == keys) & (self.pair_ranks[spot] < due)
            ok[live[clash]] = False
            single_a, single_b = self.left[a] < 0, self.left[b] < 0
            undo_a = ~single_a & (single_b | (self.rank[a] > self.rank[b]))
            # A pair at the border lies right of a merge on the left side, and left of one on the right.
            due = np.where(undo_a, self.rank[a], self.rank[b] + 1)
            go = ~clash & ~(single_a & single_b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            live, a, b, due = live[go], a[go], b[go], due[go]
        return ok


@functools.cache
def piece_table(path: str) -> PieceTable:
    """Read a sentencepiece model of the byte-pair kind without text normalisation."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    ids = np.array([i for i in range(size) if not special[i]])
    pieces = [model.id_to_piece(int(i)) for i in ids]
    if any(x != SPACE_MARK and y == SPACE_MARK for p in pieces for x, y in zip(p, p[1:], strict=False)):
        raise ValueError("a piece has a space mark inside; words cannot be encoded one by one")
    if model.normalize("a  ﬁ ") != SPACE_MARK + "a" + 2 * SPACE_MARK + "ﬁ" + SPACE_MARK:
        raise ValueError("only models that leave the text as it is are supported")
    scores = np.array([model.get_score(int(i)) for i in ids])
    _, rank = np.unique(-scores, return_inverse=True)
    ranks = {p: int(r) for p, r in zip(pieces, rank, strict=True) if len(p) > 1}
    number = {p: i for i, p in enumerate(pieces)}
    left, right = np.full(len(ids) + 1, -1), np.full(len(ids) + 1, -1)
    usable = np.zeros(len(ids) + 1, bool)
    usable[len(ids)] = True
    keys, pair_ranks = [], []
    for i, piece in enumerate(pieces):
        if len(piece) == 1:
            usable[i] = True
            continue
        done = merged(list(piece), ranks)
        if done and done[-1][0] == 0 and done[-1][2] == len(piece):
            middle = done[-1][1]
            parts = number.get(piece[:middle]), number.get(piece[middle:])
            if None not in parts:
                usable[i], left[i], right[i] = True, *parts
        for cut in range(1, len(piece)):
            parts = number.get(piece[:cut]), number.get(piece[cut:])
            if None not in parts:
                keys.append(parts[0] * (len(ids) + 1) + parts[1])
                pair_ranks.append(int(rank[i]))
    order = np.argsort(keys)
    byte_ids = np.full(256, model.unk_id())
    for i in range(size):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
    return PieceTable(
        ids, pieces, ranks, np.append(rank, -1), left, right, usable,
        np.array(keys)[order], np.array(pair_ranks)[order], byte_ids, model.unk_id(),
    )
