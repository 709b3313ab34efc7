"""What each operator should return, by the plainest means."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def quality(text):
    ws = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {j for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for j in range(i, i + 3)}
    n_symbols = sum(c in "#*$%&|<>" for c in text or "")
    chars, dups = sum(map(len, ws)), len(lines) - len(set(lines))
    base = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    more = 2 * len(ws) <= chars <= 20 * len(ws) and 10 * n_symbols <= 3 * len(ws) and 10 * dups <= len(ws)
    return len(ws), chars, n_symbols, dups, len(covered), base, not base and more


def _repeats(units, window, seen):
    covered = bytearray(len(units))
    for i in range(len(units) - window + 1):
        key = units[i : i + window]
        key = key if isinstance(key, bytes) else tuple(key)
        if key in seen:
            covered[i : i + window] = b"\1" * window
        else:
            seen.add(key)
    return covered


def repeated_words(docs, window=20):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        ws = words(text)
        covered = _repeats(ws, window, seen)
        kept = " ".join(w for w, c in zip(ws, covered, strict=True) if not c)
        out[doc_id] = (len(ws), sum(covered), hashlib.sha256(kept.encode()).hexdigest())
    return out


def repeated_bytes(docs, window=100):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        raw = (text or "").encode()
        covered = _repeats(raw, window, seen)
        kept = bytes(b for b, c in zip(raw, covered, strict=True) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        out[doc_id] = (len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def fingerprint(text, size=4):
    ws = words(lower(text))
    shingles = [ws[i : i + size] for i in range(len(ws) - size + 1)] or ([ws] if ws else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near_duplicates(docs, size=4, apart=4):
    prints = {i: fingerprint(t, size) for i, t in docs}
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (prints[a] ^ prints[b]).bit_count() <= apart]
    found = least_reachable(ids, links)
    return {i: (f"{prints[i]:016x}", found[i]) for i in ids}


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id))
    out = {}
    for text, rows in groups.items():
        keep = min(rows)[1]
        for _, doc_id in rows:
            out[doc_id] = (keep, len(rows), doc_id == keep, hashlib.sha256(text.encode()).hexdigest())
    return out


def bigram_scores(docs, weights_of):
    """Base scores, and the mixed scores under given weights per bucket of the predecessor's frequency."""
    def tokens(text):
        return [*words(lower(text)), None]

    single, pair = Counter(), Counter()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    for i, text in docs:
        if not held[i]:
            ts = tokens(text)
            single.update(ts)
            pair.update(zip([None, *ts], ts, strict=False))
    n, v = sum(single.values()), len(single)
    out = {}
    for i, text in docs:
        ts = tokens(text)
        base = sum(math.log10((single[t] + 1) / (n + v + 1)) for t in ts)
        score = 0.0
        for p, t in zip([None, *ts], ts, strict=False):
            w = weights_of(single[p].bit_length())
            score += math.log10(w[0] * pair[p, t] / max(1, single[p]) + w[1] * single[t] / max(1, n) + w[2] / (v + 1))
        out[i] = (held[i], len(ts), sum(single[t] > 0 for t in ts), n, base, score)
    return out


SENTENCE = " ".join(f"word{i} the Of" for i in range(40))

# Nulls, empties, white space, ties, repeated rows, a very long text and characters of all widths.
ODD = [
    (None, None),
    (None, SENTENCE),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, SENTENCE),
    (5, SENTENCE + "\n" + SENTENCE),
    (6, SENTENCE.replace(" ", "\n")),
    (7, SENTENCE),
    (7, SENTENCE),
    (8, "é ☃ 🎉 日本語 \u00a0 \u2028 x" * 30),
    (9, "a" * 5000),
    (10, "a " * 3000),
    (11, " ".join(str(i * 7919 % 10007) for i in range(60000))),
    (12, "one"),
    (13, "\x00 \x01"),
    (-5, "one two three four five"),
]
