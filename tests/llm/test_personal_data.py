"""Personal data against the patterns as they are written, and against a plain version of the bootstrapping."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from brute import ODD

from flatloom.llm import personal_data as pd
from flatloom.llm.queries import QUERIES

KINDS = ("email", "ip", "card", "phone")
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    found = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                k != 1 or all(int(p) <= 255 for p in m[0].split(".")),
                k != 2 or (14 <= len(digits) <= 19 and luhn(digits)),
                k != 3 or 10 <= len(digits) <= 15,
            )
            if all(good):
                found.append((m.start(), k, m.end()))
    return sorted(found)


def written(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def brute(texts, rounds=3):
    """The added spans of each text, with words for hashes."""
    fillers, slots = defaultdict(set), []
    kinds = defaultdict(set)
    for t, text in enumerate(texts):
        text = text or ""
        ws = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        low = [re.sub("[A-Z]", lambda m: m[0].lower(), w[0]) for w in ws]
        marked = [bool(re.search("[0-9@]", w[0])) for w in ws]
        at = lambda i, low=low: low[i] if 0 <= i < len(low) else ("begin" if i < 0 else "end",)
        i = 0
        while i < len(ws):
            j = i
            while marked[i] and j + 1 < len(ws) and marked[j + 1]:
                j += 1
            contexts = [("A", at(i - 2), at(i - 1)), ("B", at(i - 1), at(j + 1))]
            if marked[i]:
                s, e = ws[i][1], ws[j][2]
                part = text[s:e]
                s += len(part) - len(part.lstrip("\"'`()[]{}<>,;:.!?"))
                part = part.strip("\"'`()[]{}<>,;:.!?")
                e = s + len(part)
                kinds[part] |= {k for x, k, y in base(text) if x < e and y > s}
                slots.append((t, s, e, part, not any(x < e and y > s for x, k, y in base(text))))
                for c in contexts:
                    fillers[c].add((True, part))
            else:
                for c in contexts:
                    fillers[c].add((False, low[i]))
            i = j + 1
    fillers = {c: f for c, f in fillers.items() if sum(x for x, _ in f) >= 3}
    patterns_of = defaultdict(set)
    for c, f in fillers.items():
        for is_slot, part in f:
            if is_slot:
                patterns_of[part].add(c)
    seeds = {(p, k): 1000 for p in patterns_of for k in kinds[p]}
    known, found = dict(seeds), {}
    for _ in range(rounds):
        good = {}
        for c, f in fillers.items():
            for k in range(4):
                scores = [known[p, k] for is_slot, p in f if is_slot and (p, k) in known]
                if len(scores) >= 3 and sum(scores) // len(f) >= 800:
                    good[c, k] = sum(scores) // len(f)
        found = {}
        for p, cs in patterns_of.items():
            if not kinds[p]:
                options = []
                for k in range(4):
                    votes = [good[c, k] for c in cs if (c, k) in good]
                    if votes and max(votes) * len(votes) // len(cs) >= 400:
                        options.append((max(votes) * len(votes) // len(cs), -k))
                if options:
                    found[p] = max(options)
        known = {**seeds, **{(p, -k): score for p, (score, k) in found.items()}}
    added = defaultdict(set)
    for t, s, e, part, free in slots:
        if free and part in found:
            added[t].add((s, -found[part][1], e))
    return added


def check(rows, found):
    """Rows (id, text) against (id, text hash or None, counts, spans)."""
    added = brute([t for _, t in rows])
    expected = Counter()
    for n, (i, text) in enumerate(rows):
        own = base(text)
        counts = tuple(sum(k == kind for _, k, _ in own) for kind in range(4))
        digest = hashlib.sha256(written(own).encode()).hexdigest()
        expected[(i, *counts, digest, written(sorted({*own, *added[n]})))] += 1
    assert found == expected
    return added


def test_query(spark, sf_dir, documents):
    found = QUERIES["op13_personal_data"](spark, sf_dir).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )
    check(documents, Counter(map(tuple, found.collect())))


def run(frame, rows):
    out = []
    for r in pd.personal_data(frame(rows)).collect():
        own = [(s.start, s.kind, s.end) for s in r.base]
        counts = tuple(sum(k == kind for _, k, _ in own) for kind in range(4))
        assert r.base_text == written(own)
        out.append((r.row.doc_id, *counts, hashlib.sha256(r.base_text.encode()).hexdigest(), r.spans_text))
    return Counter(out)


PLANTED = [
    *[(i, f"Filler number one here. Please write to: user{i}@mail{i % 5}.org today, thanks {'x' * (i % 7)}") for i in range(12)],
    (50, "And so please write to: jane(at)corp77 today, she said"),  # found by both contexts
    (51, "Then jane(at)corp77 was seen elsewhere"),  # known from there
    *[(60 + i, f"Call us on +1 (499) 555-65{i:02d} or so") for i in range(9)],
    (70, "Call us on 555-0199 or so"),
    *[(80 + i, f"born in {1900 + i} they said") for i in range(30)],  # numbers of no kind
    (120, "born in +1 499 555 6503 they said"),
    (121, "call us on monday or so"),
    *[(200 + i, f"the code {i}77-A is theirs") for i in range(5)],
    # A second step: contexts that only a discovered number has in common with seeds.
    (130, "ring 555-0199 now please"), (131, "ring +1 (499) 555-6501 now please"), (132, "ring +1 (499) 555-6502 now please"),
    (133, "ring 555-0777x now please"),
]


def test_planted_contexts(frame):
    added = check(PLANTED, run(frame, PLANTED))
    texts = [t for _, t in PLANTED]
    got = {texts[n][s:e] for n, spans in added.items() for s, _, e in spans}
    assert {"jane(at)corp77", "555-0199"} <= got
    assert not any(x.startswith(("19", "77")) or x.endswith("-A") for x in got)


def test_odd_rows(frame):
    rows = [*ODD, (900, "a@b"), (901, "@"), (902, "é1.2.3.4 ü@x.y.z 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004"), *PLANTED]
    check(rows, run(frame, rows))


def test_no_rows(frame):
    assert pd.personal_data(frame([])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_entities_are_those_of_the_written_patterns(seed):
    draw = random.Random(seed)
    parts = ["1", "12", "255", "256", ".", "..", "@", "a", "b-c", "x.y", "+", "+1", " ", "  ", "-", "(", ")", "%", "4111 1111 1111 1111", "4111111111111111", "é", "\n"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(1, 25)))
        data = text.encode()
        found = [(len(data[:s].decode()), k, len(data[:e].decode())) for s, k, e in pd.entities(data)]
        assert found == base(text), text


def test_very_long_runs_take_linear_time():
    for text in (b"1" * 400_000, b"a" * 400_000 + b"@", b"1 " * 200_000, b"a@" * 200_000, b"+1" + b"(" * 400_000, b"1." * 200_000):
        pd.entities(text)
