"""The pipeline's stages, each against a brute-force version on what it was given."""

from collections import defaultdict
from pathlib import Path

import brute

import corpus_pipeline
from flatloom.llm import packing
from flatloom.scratch import scratch_root


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    now = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        texts = [(i, r.text) for i, r in now.items()]
        if name == "best_fit_packing":
            break
        assert docs.columns == columns
        found = {r.doc_id: r for r in rows}
        assert len(found) == len(rows)
        if name == "quality_rules":
            assert set(found) == {i for i, t in texts if brute.quality(t)[6]}
        if name == "exact_dedup":
            assert set(found) == {i for i, v in brute.exact(texts).items() if v[2]}
        if name == "simhash_dedup":
            assert set(found) == {v[1] for v in brute.near_duplicates(texts).values()}
        if name == "substring_dedup":
            kept = brute.repeated_words(texts)
            assert set(found) == set(now)
            for i, r in found.items():
                assert len(brute.words(r.text)) == kept[i][0] - kept[i][1]
                assert r.n_chars == len(r.text)
                assert kept[i][1] or r == now[i]
        else:
            assert all(found[i] == now[i] for i in found)
        now = found
    encode = packing.encoder(corpus_pipeline.tokenizer("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        ids[r.doc_id] += r.ids
    assert ids == {i: [*encode(r.text).tolist(), 2] for i, r in now.items()}
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_run(spark, sf_dir):
    before = set(Path(scratch_root(spark)).iterdir())
    assert corpus_pipeline.run(spark, sf_dir).filter("offset + length > 1024").count() == 0
    # Only the last stage's table is left.
    assert len(set(Path(scratch_root(spark)).iterdir()) - before) == 1
