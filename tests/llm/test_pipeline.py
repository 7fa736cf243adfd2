"""The pipeline's stages, each against a plain reading of what it says it does."""

from __future__ import annotations

import pytest

import corpus_pipeline
from shoplens.llm import fertility, mixing, pii, segment, simhash, toxicity
from shoplens.scratch import materialize


@pytest.fixture(scope="module")
def stages(spark, testdata):
    folder = f"{testdata}/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], folder), name))
    return out


def test_stages_hold_few_texts_at_once(spark, testdata):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.read.parquet(f"{testdata}/sf0.01/documents.parquet")
    try:
        for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.mask_personal_data, corpus_pipeline.encode):
            for before, after in (("10000", 256), ("0", 256), ("100", 100)):
                spark.conf.set(name, before)
                stage(spark, docs.limit(3), f"{testdata}/sf0.01")
                assert int(spark.conf.get(name)) == after
    finally:
        spark.conf.unset(name)
    assert max(s.stop - s.start for s in segment._chunks(["x" * 20_000] * 10)) <= 2


def test_all_but_the_last_return_documents(stages):
    assert all(s.schema == stages[0].schema for s in stages[:-1])


def test_toxic_documents_go(spark, testdata, stages):
    labels = spark.read.parquet(f"{testdata}/sf0.01/labels.parquet")
    scores = {r.key: r.score for r in toxicity.score(stages[0], toxicity.fit(stages[0], labels)).collect()}
    assert {r.doc_id for r in stages[1].collect()} == {d for d, s in scores.items() if s < 0.5}


def test_one_of_each_group_stays(stages):
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in stages[1].collect()}
    kept = {r.doc_id for r in stages[2].collect()}
    group, left = {}, set(prints)
    while left:
        start = min(left)
        reached, todo = {start}, [start]
        while todo:
            near = {e for e in left - reached if (prints[todo[-1]] ^ prints[e]).bit_count() <= 2}
            todo.pop()
            reached |= near
            todo += near
        group[start] = reached
        left -= reached
    assert kept == set(group) and stages[2].count() == len(kept)


def test_texts_are_masked(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert {d: r.text for d, r in after.items()} == {d: pii.mask(x) for d, x in before.items()}
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_documents_are_sent_as_often_as_the_mix_says(stages):
    times = {r.key: r.times for r in mixing.mix_counts(stages[3]).collect()}
    sent = {}
    for r in stages[4].collect():
        sent[r.doc_id] = sent.get(r.doc_id, 0) + 1
    assert sent == {d: n for d, n in times.items() if n}


def test_ids_decode_to_the_texts(stages):
    vocabulary = segment.Vocabulary(fertility.read_vocabulary(fertility.VOCABULARY))
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert all(segment.decode(r.ids, vocabulary) == texts[r.doc_id] for r in rows)
    assert sum(r.sample == 1 for r in rows) == stages[4].count()
    own = {}
    for r in rows:
        own.setdefault(r.doc_id, set()).add((r.sample, tuple(r.ids)))
    # Some texts have a single segmentation; otherwise there are two, and they differ.
    assert all(len({ids for _, ids in found}) == len(found) == max(s for s, _ in found) <= 2 for found in own.values())
    assert sum(len(found) == 2 for found in own.values()) > 0.9 * len(own)


def test_run_gives_the_last_stage(spark, testdata, stages):
    again = corpus_pipeline.run(spark, f"{testdata}/sf0.01")
    assert sorted(again.collect()) == sorted(stages[-1].collect())
