"""Every dealt operator against its brute-force version, on a given table and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import ODD
from tokenizers import Tokenizer

import __spark_entry__ as contract
from flatloom.llm import exact_dedup, language_model, line_dedup, packing, quality, repeats, sentence_pieces, simhash
from flatloom.llm import substring_dedup, suffix_dedup
from flatloom.llm.language_model import fitted_weights

# Rows whose id is theirs alone, on which results can be keyed.
SINGLE = [r for r in ODD if r[0] not in (None, 7)] + [(7, ODD[8][1])]


def by_id(rows):
    return {r[0]: tuple(r[1:]) for r in rows}


def run(spark, name, sf_dir):
    return contract.queries()[name](spark, sf_dir)


# Quality rules


def test_quality_query(spark, sf_dir, documents):
    found = by_id(run(spark, "op1_quality_rules", sf_dir).collect())
    assert found == {i: brute.quality(t) for i, t in documents}


def test_quality_of_odd_rows(frame):
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = quality.judged(frame(ODD), measures=measures).select("row.doc_id", *measures, "kept").collect()
    expected = [(i, *brute.quality(t)[:5], brute.quality(t)[6]) for i, t in ODD]
    assert Counter(map(tuple, found)) == Counter(expected)
    assert quality.kept_documents(frame(ODD)).columns == frame(ODD).columns


def test_order_of_rules_does_not_change_verdicts(frame, monkeypatch):
    kept = {tuple(r) for r in quality.kept_documents(frame(ODD)).collect()}
    monkeypatch.setattr(quality, "ordered", lambda rules, _: rules[::-1])
    assert {tuple(r) for r in quality.kept_documents(frame(ODD)).collect()} == kept


def test_rules_are_ordered_by_rejections_per_cost():
    rules = quality.RULES[:3]
    figures = [(1.0, 0.5), (1.0, 0.9), (0.1, 0.5)]
    estimates = [{"name": r.name, "cost": c, "rejects": x} for r, (c, x) in zip(rules, figures, strict=True)]
    assert quality.ordered(rules, estimates) == (rules[2], rules[1], rules[0])


# Substring dedup, on words and on bytes


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeated_words(spark, sf_dir, documents, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    assert by_id(run(spark, "op2_substring_dedup", sf_dir).collect()) == brute.repeated_words(documents)


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeated_bytes(spark, sf_dir, documents, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    assert by_id(run(spark, "op3_suffix_dedup", sf_dir).collect()) == brute.repeated_bytes(documents)


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeats_in_odd_rows(frame, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    words = substring_dedup.repeated_words(frame(SINGLE)).select("row.doc_id", "n_units", "n_removed", "kept")
    assert by_id(words.collect()) == brute.repeated_words(SINGLE)
    found = suffix_dedup.repeated_bytes(frame(SINGLE)).select("row.doc_id", "n_units", "n_removed", "n_spans", "kept")
    assert by_id(found.collect()) == brute.repeated_bytes(SINGLE)


def test_small_windows_and_shards(frame, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_SYMBOLS", 64)
    rng = np.random.default_rng(3)
    docs = [(int(i), " ".join("abc"[c] for c in rng.integers(0, 3, rng.integers(0, 60)))) for i in rng.permutation(40)]
    found = substring_dedup.repeated_words(frame(docs), window=5, anchor=2)
    expected = brute.repeated_words(docs, 5)
    assert by_id(found.select("row.doc_id", "n_units", "n_removed", "kept").collect()) == expected
    found = suffix_dedup.repeated_bytes(frame(docs), window=9, anchor=3)
    expected = brute.repeated_bytes(docs, 9)
    assert by_id(found.select("row.doc_id", "n_units", "n_removed", "n_spans", "kept").collect()) == expected


def test_rows_with_one_id_tie(frame):
    """Repeated rows of the smallest id both keep their words; later ids lose theirs."""
    text = ODD[1][1]
    found = substring_dedup.repeated_words(frame([(1, text), (1, text), (2, text)])).select("row.doc_id", "n_removed")
    assert sorted(map(tuple, found.collect())) == [(1, 0), (1, 0), (2, 120)]
    null_first = substring_dedup.repeated_words(frame([(None, text), (2, text)])).select("row.doc_id", "n_removed")
    assert {tuple(r) for r in null_first.collect()} == {(None, 0), (2, 120)}


def test_texts_without_repeated_words(frame):
    text = ODD[1][1]
    found = substring_dedup.without_repeated_words(frame([(1, text), (2, "new  \n" + text + "\n\nend")]))
    assert found.columns == frame([]).columns
    assert {r.doc_id: r.text for r in found.collect()} == {1: text, 2: "new  \nend"}


# Near-duplicates


def test_simhash_query(spark, sf_dir, documents):
    assert by_id(run(spark, "op4_simhash_dedup", sf_dir).collect()) == brute.near_duplicates(documents)


def test_simhash_of_odd_rows(frame):
    found = simhash.near_duplicates(frame(SINGLE)).select("row.doc_id", "fingerprint", "component_id").collect()
    assert {r[0]: (f"{r[1] % 2**64:016x}", r[2]) for r in found} == brute.near_duplicates(SINGLE)
    with_null = simhash.near_duplicates(frame(ODD)).select("row.doc_id", "component_id")
    assert (None, None) in {tuple(r) for r in with_null.collect()}


def test_links_of_a_dense_ball_and_deep_trees(spark, monkeypatch):
    """All links are found when leaves are tiny and when a leaf is cut into tiles."""
    rng = np.random.default_rng(5)
    centers = rng.integers(0, 2**62, 30)
    prints = set()
    for c in centers.tolist():
        for _ in range(40):
            p = c
            for bit in rng.integers(0, 63, rng.integers(0, 9)).tolist():
                p ^= 1 << bit
            prints.add(p)
    prints = sorted(prints)
    table = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    links = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 4]
    expected = brute.least_reachable(prints, links)
    for leaf, tile in ((8, 16384), (10**6, 50), (16, 8)):
        monkeypatch.setattr(simhash, "LEAF_TARGET", leaf)
        monkeypatch.setattr(simhash, "TILE_MEMBERS", tile)
        found = [(r.a, r.b) for r in simhash.linked(table).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in found)
        assert brute.least_reachable(prints, found) == expected


def test_components(spark):
    from flatloom.llm.components import components

    rng = np.random.default_rng(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    random = [tuple(map(int, rng.integers(600, 700, 2))) for _ in range(60)]
    edges = [*chain, *star, *random, (9, 9), (None, 4)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    nodes = {x for e in edges if None not in e for x in e}
    assert found == brute.least_reachable(nodes, [e for e in edges if None not in e])
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_one_of_each_group_stays(frame):
    left = simhash.one_of_each_group(frame(SINGLE))
    roots = {v[1] for v in brute.near_duplicates(SINGLE).values()}
    assert {r.doc_id for r in left.collect()} == roots and left.columns == frame([]).columns


# Exact duplicates


def test_exact_query(spark, sf_dir, documents):
    assert by_id(run(spark, "op5_exact_dedup", sf_dir).collect()) == brute.exact(documents)


def test_exact_odd_rows(frame):
    assert by_id(exact_dedup.with_digests(frame(SINGLE)).collect()) == brute.exact(SINGLE)
    everything = exact_dedup.with_digests(frame(ODD)).collect()
    assert len(everything) == len(ODD)
    sentence = [r for r in everything if r.text_sha256 == hashlib.sha256(re.sub(r"\s", "", ODD[1][1]).encode()).hexdigest()]
    # The null id is the smallest of those with the most code points.
    assert {(r.keep_id, r.group_size) for r in sentence} == {(None, 5)}
    left = exact_dedup.without_copies(frame([r for r in ODD if r[0] is not None]))
    assert sorted(r.doc_id for r in left.collect()) == [-5, 3, 4, 5, 8, 9, 10, 11, 12, 13]
    assert left.columns == frame([]).columns


def test_exact_plan_has_no_python(frame):
    plan = exact_dedup.with_digests(frame(SINGLE))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Lines


def brute_lines(docs, rare=4, min_words=8):
    lines, holders = {}, defaultdict(list)
    for doc_id, text in sorted(docs):
        seen, own = Counter(), []
        for x in (text or "").split("\n"):
            if brute.words(x):
                own.append((x, seen[x]))
                seen[x] += 1
        lines[doc_id] = own
        for place, key in enumerate(own):
            holders[key].append((doc_id, place))
    pairs = defaultdict(list)
    for key, held in holders.items():
        for n, (b, place_b) in enumerate(held):
            for a, place_a in held[:n] if len(held) <= rare else held[: min(n, 1)]:
                pairs[a, b].append((place_b, place_a, len(brute.words(key[0]))))
    gone = defaultdict(set)
    for (_, b), common in pairs.items():
        common.sort()
        best = [[i] for i in range(len(common))]
        for i, (_, place, _) in enumerate(common):
            for j in range(i):
                if common[j][1] < place and len(best[j]) >= len(best[i]):
                    best[i] = [*best[j], i]
        length = max(map(len, best))
        places = line_dedup.aligned_blocks([c[1] for c in common], [c[0] for c in common], [c[2] for c in common], min_words)
        chain = line_dedup.longest_increasing([c[1] for c in common])
        assert len(chain) == length
        gone[b] |= set(places)
    return {i: (len(own), len(gone[i])) for i, own in lines.items()}


def test_line_query(spark, sf_dir, documents):
    found = run(spark, "op7_line_dedup", sf_dir).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed) for r in found} == brute_lines(documents)
    texts = dict(documents)
    for r in found:
        if r.n_removed == 0:
            assert r.kept_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_lines_of_odd_rows(frame):
    found = line_dedup.without_aligned_lines(frame(SINGLE)).select("row.doc_id", "n_lines", "n_removed").collect()
    assert {r.doc_id: (r.n_lines, r.n_removed) for r in found} == brute_lines(SINGLE)
    assert line_dedup.without_aligned_lines(frame(ODD)).count() == len(ODD)


def test_aligned_block_is_cut_from_the_later_text(frame):
    block = "one two three four\n\nfive six seven eight"
    docs = [(1, f"x\n{block}\ny"), (2, f"p\n{block}\nq\ny")]
    kept = line_dedup.without_aligned_lines(frame(docs), output="text").select("row.doc_id", "kept").collect()
    assert {r.doc_id: bytes(r.kept).decode() for r in kept} == {1: docs[0][1], 2: "p\n\nq\ny"}


# SentencePiece


def test_pieces_equal_those_of_the_library(spark, sf_dir, documents, frame):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = run(spark, "op8_sentence_pieces", sf_dir).collect()
    expected = {i: model.encode(t) for i, t in documents}
    crc = {i: zlib.crc32(np.array(x, "<u4").tobytes()) for i, x in expected.items()}
    assert {r.doc_id: (r.n_pieces, r.ids_crc32) for r in found} == {i: (len(x), crc[i]) for i, x in expected.items()}
    assert all(r.round_trip for r in found)
    odd = sentence_pieces.encoded(frame(SINGLE), path)
    assert {r.row.doc_id: r.ids for r in odd.collect()} == {i: model.encode(t or "") for i, t in SINGLE}
    back = sentence_pieces.decoded(odd.select("row.doc_id", "ids"), path).collect()
    assert {r.row.doc_id: r.text for r in back} == {i: t or "" for i, t in SINGLE}


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "   ", "<s>", "▁x", "x" * 300, " " * 50 + "z", "a    b       c  ", "\ufeff\x00"])
def test_pieces_of_odd_texts(text):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = sentence_pieces.Encoder(path).encode([text])[0].tolist()
    assert ids == model.encode(text)
    assert sentence_pieces.Decoder(path).decode(ids) == model.decode(ids)


# Packing


def check_packed(rows, docs, capacity=1024):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(of_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // capacity)))
        assert all(r.length == capacity for r in pieces[1:])
        at = 0
        for r in pieces:
            raw = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(raw))
            at += r.length
        assert at == len(ids)
    for members in of_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    return len(of_sequence), -(-total // capacity)


def test_packing_query(spark, sf_dir, documents):
    used, least = check_packed(run(spark, "op9_best_fit_packing", sf_dir).collect(), documents)
    assert used <= 1.02 * least + 2


def test_packing_odd_rows(frame, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    columns = ["row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_packed(packing.packed(frame(SINGLE), path).select(*columns).collect(), SINGLE)
    monkeypatch.setattr(packing, "GROUP_PIECES", 5)
    check_packed(packing.packed(frame(SINGLE), path).select(*columns).collect(), SINGLE)
    ids = packing.packed(frame([(1, "x y")]), path, with_ids=True).select("ids").collect()
    assert [r.ids for r in ids] == [[*Tokenizer.from_file(path).encode("x y").ids, 2]]


def test_sum_of_squares_prefers_the_flattest_gaps():
    bins, offsets = packing.sum_of_squares(np.array([6, 6, 5, 4, 2]), 10)
    # 4 goes to one of the two equal gaps and fills it; 2 goes to the gap that leaves the sum smallest.
    assert sorted(np.bincount(bins, [6, 6, 5, 4, 2]).tolist()) == [5, 8, 10]
    assert all(o in (0, 6) for o in offsets)


# Language model


def fitted(monkeypatch):
    seen = {}
    original = language_model._scores

    def spy(n_tokens, n_types, weights):
        seen["weights"] = weights
        return original(n_tokens, n_types, weights)

    monkeypatch.setattr(language_model, "_scores", spy)
    return seen


def test_scores(spark, sf_dir, documents, monkeypatch):
    seen = fitted(monkeypatch)
    rows = run(spark, "op10_language_model", sf_dir).collect()
    expected = brute.bigram_scores(documents, lambda b: seen["weights"][b])
    for r in rows:
        e = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:4]
        assert (r.base_score, r.score) == pytest.approx(e[4:], rel=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_odd_rows(frame, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 5000)
    monkeypatch.setattr(language_model, "RANGE_KEYS", 1000)
    seen = fitted(monkeypatch)
    rows = language_model.scored(frame(SINGLE)).collect()
    expected = brute.bigram_scores(SINGLE, lambda b: seen["weights"][b])
    assert len(rows) == len(SINGLE)
    for r in rows:
        assert tuple(r)[1:5] == expected[r.doc_id][:4]
        assert tuple(r)[5:] == pytest.approx(expected[r.doc_id][4:], rel=1e-9)
    assert language_model.scored(frame(ODD)).count() == len(ODD)


def test_weights_are_those_of_expectation_maximisation():
    """One bucket, tokens that either estimate explains alone: the weights are their shares."""
    none = language_model._NONE
    cells = np.array([[3, 40, none, 30], [3, none, 40, 70]])
    weights = fitted_weights(cells, 500)
    assert weights[3] == pytest.approx([0.3, 0.7, 0], abs=0.01)
    assert weights[9] == pytest.approx(weights[3])


# No rows


def test_empty_tables(frame):
    empty = frame([])
    path = public_tokenizers.path
    assert quality.kept_documents(empty).collect() == []
    assert substring_dedup.repeated_words(empty).collect() == []
    assert suffix_dedup.repeated_bytes(empty).collect() == []
    assert simhash.near_duplicates(empty).collect() == []
    assert exact_dedup.with_digests(empty).collect() == []
    assert line_dedup.without_aligned_lines(empty).collect() == []
    assert sentence_pieces.encoded(empty, path("piece_bpe_32k.model")).collect() == []
    assert packing.packed(empty, path("byte_bpe_50k.json")).collect() == []
    assert language_model.scored(empty).collect() == []
