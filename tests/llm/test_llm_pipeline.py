"""The corpus pipeline against a brute-force version of its stages."""

from collections import Counter

import pytest
from llm_fixtures import awkward, empty

import corpus_pipeline
from shelfwise.llm import minhash, mixing, pieces, quality
from shelfwise.llm._common import written
from shelfwise.llm.queries import vocabulary

SMOKE = "/root/testdata/sf0.001"


def _five(text):
    w = text.encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_pipeline_matches_brute_force(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    score = {r.doc_id: r.score for r in quality.classify(docs, spark.read.parquet(f"{SMOKE}/labels.parquet")).collect()}
    left = {r.doc_id: r for r in docs.collect() if score[r.doc_id] >= 0.3}
    sets = {i: _five(r.text) for i, r in left.items()}
    up = {i: i for i in left}
    for _ in left:  # smallest reachable id, until nothing changes
        new = {a: min([up[a]] + [up[b] for b in left if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]) for a in left}
        if new == up:
            break
        up = new
    left = {i: r for i, r in left.items() if up[i] == i}
    plan = {r.doc_id: r.copies for r in mixing.mix_documents(spark.createDataFrame(list(left.values()), docs.schema)).collect()}
    lib = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    want = Counter()
    for i, r in left.items():
        if plan[i]:
            want[i, tuple(lib.encode(r.text))] += plan[i]
    out = corpus_pipeline.run(spark, SMOKE).collect()
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in out) == want
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in out)


def test_stages_keep_the_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "mixing", "sentencepiece"]
    for docs in (awkward(spark), empty(spark)):
        docs = written(docs, "docs")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SMOKE).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).count() == docs.count()
