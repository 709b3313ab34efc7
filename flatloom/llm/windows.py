"""Windows of a fixed number of symbols, grouped by the anchor that each contains.

The anchor of a window is the k-gram with the smallest hash in it, the leftmost on a tie. It
follows from the window's symbols alone, so equal windows have equal anchors at the same
place. Neighbouring windows mostly share one occurrence of an anchor: they form a region.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from flatloom.llm.text import U64, Rolling, mix

# Windows looked at together; the low bits of the sort key hold a place within them.
_STEP = 1 << 20
_PLACE = U64((1 << 22) - 1)
_SPREAD = U64(0xD6E8FEB86659FD93)


@dataclass
class Regions:
    """Runs of window starts with one anchor occurrence; ``count`` windows begin at ``start``."""

    anchor: np.ndarray
    start: np.ndarray
    count: np.ndarray


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[: len(values) - (width - span)], values[width - span :])
    return values


def regions(values: np.ndarray, bounds: np.ndarray, window: int, k: int) -> Regions:
    """The regions of all windows of each text.

    ``values`` has one 64-bit value per symbol, ``bounds`` the first symbol of each text and
    the end. At most ``window - k + 1`` windows share a region.
    """
    width = window - k + 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    total = len(values) - window + 1
    legal = np.zeros(max(total, 0), bool)
    for first, last in zip(bounds[:-1].tolist(), (bounds[1:] - window + 1).tolist(), strict=True):
        if first < last:
            legal[first:last] = True
    for at in range(0, max(total, 0), _STEP):
        size = min(_STEP, total - at)
        part = values[at : at + size + window - 1]
        hashes = Rolling(part).grams(k)
        # Multiplied, so that all bits of the hash reach the high ones, which are compared.
        keys = ((hashes * _SPREAD) & ~_PLACE) | np.arange(len(hashes), dtype=U64)
        place = (_sliding_min(keys, width) & _PLACE).view(np.int64)
        ok = legal[at : at + size]
        new = ok.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~ok[:-1]
        starts = np.flatnonzero(new)
        # A region ends where the next begins, or where a text has no further window.
        stops = np.append(np.flatnonzero(ok[:-1] & ~ok[1:]) + 1, size)
        counts = np.minimum(np.append(starts[1:], size), stops[np.searchsorted(stops, starts, "right")]) - starts
        found.append((mix(hashes[place[starts]]).view(np.int64), starts + at, counts))
    if not found:
        return Regions(*(np.zeros(0, np.int64) for _ in range(3)))
    return Regions(*(np.concatenate(x) for x in zip(*found, strict=True)))
