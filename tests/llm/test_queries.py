"""Registered queries: their SQL, the classifier's held-out accuracy, and the pipeline against a plain version."""

import zlib

import numpy as np
import pytest
from oracle import compare, oracle_connection

import __spark_entry__ as entry
import corpus_pipeline
from zonetide.llm import toxicity
from zonetide.llm.common import table
from zonetide.llm.queries import ORACLES, QUERIES

from test_near import groups  # isort: skip
from test_rows import base_spans, figures, library  # noqa: F401  # isort: skip


def test_all_registered():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    assert compare(spark, oracle_connection("0.01"), QUERIES[key], ORACLES[key], "0.01") is None


def test_toxicity_on_rows_kept_from_training(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    rows = [(got[r.doc_id], r.toxic) for r in labels.collect() if r.doc_id in got]
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) for g in got.values())
    rows = [(g.score, y) for g, y in rows if g.held_out]
    score, y = np.array([s for s, _ in rows]), np.array([y for _, y in rows])
    rank = np.argsort(np.argsort(score))
    area = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())
    assert area > 0.9
    assert ((score >= 0.5) == y).mean() > 0.9


def test_toxicity_odd_rows(spark, odd, make):
    labels = spark.createDataFrame([(4, 1, "z"), (5, 0, "z"), (None, 1, "z"), (6, None, "z"), (5, 1, "z")], "doc_id bigint, toxic int, score string")
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.toxicity(make([]), labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).count() == odd.count()


def test_misspelling_scores_like_the_word():
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    texts, labels = [], []
    for k in range(400):
        words = list(rng.choice(plain, 40))
        if k % 2:
            words[5] = "worthless"
        texts.append(" ".join(words))
        labels.append(k % 2)
    model = toxicity.train(texts, labels, [1.0] * 400)
    known, near, other = model.words(["worthless", "worthlesss", "abcdef"])
    assert near > 0.3 * known > 0 and known > 3 * other


def test_pipeline_stage_by_stage(spark, sf_dir, library):  # noqa: F811
    docs = table(spark, sf_dir, "documents")
    items = [r.text for r in table(spark, sf_dir, "benchmark").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r.text for r in docs.collect()}

    good = {r.doc_id: r.text for r in stages[names[0]](spark, docs, sf_dir).collect()}
    for i, t in rows.items():
        n, _, _, _, repeated = figures(t)
        if n < 50 or 100 * repeated > 50 * n:
            assert i not in good
    assert all(rows[i] == t for i, t in good.items())
    now = docs.filter(docs.doc_id.isin(list(good)))

    one = {r.doc_id for r in stages[names[1]](spark, now, sf_dir).collect()}
    assert one == set(groups(sorted(good.items())))
    now = now.filter(now.doc_id.isin(list(one)))

    clean = {r.doc_id for r in stages[names[2]](spark, now, sf_dir).collect()}
    assert clean == {i for i in one if not any(t in rows[i] for t in items)}
    now = now.filter(now.doc_id.isin(list(clean)))

    out = stages[names[3]](spark, now, sf_dir)
    assert out.columns == docs.columns
    private = {r.doc_id: r.text for r in out.collect()}
    assert set(private) == clean
    assert not any(base_spans(t) for t in private.values())
    assert all(private[i] == rows[i] for i in clean if not base_spans(rows[i]))

    last = {r.doc_id: r for r in stages[names[4]](spark, out, sf_dir).collect()}
    assert {i: r.ids for i, r in last.items()} == {i: library.encode_ordinary(t) for i, t in private.items()}


def test_pipeline_odd_rows(spark, odd, make, sf_dir):
    n = odd.count()
    # Quality rejects all of these rows, being short or repetitive; of the others each group of words keeps one; nothing is private.
    want = dict(zip([name for name, _ in corpus_pipeline.STAGES], (0, 7, n, n, n)))
    for docs in (odd, make([])):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_dir)
            found = out.collect()
            assert len(found) == (want[name] if docs is odd else 0), name
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
                assert {repr(r) for r in found} <= {repr(r) for r in docs.collect()}
