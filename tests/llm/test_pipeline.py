"""The pipeline, stage by stage, against plain Python."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from millrace.llm import curation, mixing, screening, simhash, tokens, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def near(fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if ((fps[i] ^ fps[j]) & ((1 << 64) - 1)).bit_count() <= screening.RADIUS:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


@pytest.fixture(scope="module")
def stages(spark, small):
    """The rows behind every stage."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        out.append(docs.cache())
    return out


def test_every_stage_but_the_last_gives_documents(spark, small, stages):
    for stage in stages[:-1]:
        assert stage.columns == COLUMNS
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_toxic_documents_go(spark, small, stages):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = screening.toxicity_model(spark, small, docs)
    want = {r.doc_id for r in docs.select("doc_id", model.score("text").alias("s")).filter("s < 0.7").collect()}
    assert {r.doc_id for r in stages[0].collect()} == want
    clean = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").filter("toxic = 0").collect()}
    assert len(clean & want) >= 0.98 * len(clean)


def test_copies_go(stages):
    groups = defaultdict(list)
    for r in stages[0].collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text)].append(r.doc_id)
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted(min(ids) for ids in groups.values())


def test_near_copies_go(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    comps = near([simhash.simhash(t, screening.SHINGLE) for _, t in rows])
    want = {c: min(i for (i, _), d in zip(rows, comps) if d == c) for c in set(comps)}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want.values())


def test_the_mix_holds_its_targets(stages, words):
    plan = mixing.mix_plan(stages[2], curation.WEIGHTS, seed=curation.SEED).collect()
    originals = {r.doc_id: r for r in stages[2].collect()}
    taken = defaultdict(int)
    for r in stages[3].collect():
        assert r == originals[r.doc_id]
        taken[r.doc_id] += len(words(r.text))
    assert {r.doc_id: r.taken for r in plan if r.taken} == dict(taken)


def test_all_that_is_left_is_encoded(spark, small, stages):
    coder = tokens.encoder(tokens.read_ranks(public_tokenizers.path(curation.RANKS)), public_tokenizers.PATTERN)
    want = sorted((r.doc_id, hashlib.sha256(np.array(coder.encode_ordinary(r.text), dtype="<u4").tobytes()).hexdigest(),
                   hashlib.sha256(r.text.encode()).hexdigest()) for r in stages[3].collect())
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in stages[4].collect()) == want
    run = corpus_pipeline.run(spark, small).collect()
    assert sorted(map(str, run)) == sorted(map(str, stages[4].collect()))


def test_stages_take_odd_rows(spark, small, odd, empty):
    for frame in (odd, empty):
        docs = frame.select(*COLUMNS)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small)
        assert docs.count() <= 2 * frame.count()
    assert toxicity.reject(odd, screening.toxicity_model(spark, small, odd)).columns == odd.columns
