"""The quality model: held-out accuracy, folds, scoring and edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_cases import documents, edge_docs, no_docs

from tallyroom.llm import quality

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_held_out_documents(spark, labels):
    rows = quality.scored(documents(spark, FOLDER), labels).collect()
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == documents(spark, FOLDER).count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    good = [r.predicted == 1 for r in held if known[r.doc_id] == 1]
    bad = [r.predicted == 0 for r in held if known[r.doc_id] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) > 0.9


def test_held_out_labels_change_nothing(spark, labels):
    docs = documents(spark)
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(quality.F.col("doc_id")), 1 - labels.quality).otherwise(labels.quality))
    same = quality.scored(docs, labels, sample=300).collect(), quality.scored(docs, flipped, sample=300).collect()
    assert sorted(same[0]) == sorted(same[1])


def test_edges(spark, labels):
    docs = edge_docs(spark, "score string, held_out long, _score long, predicted string")
    rows = quality.scored(docs, labels).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted((r.doc_id for r in docs.collect()), key=str)
    assert all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert quality.scored(no_docs(spark), labels).count() == 0
    without = quality.scored(docs, labels.limit(0)).collect()
    assert {r.score for r in without} == {0.5}
    odd = spark.createDataFrame([(None, 1), (5, None), (5, 1), (5, 0), (99, 0)], "doc_id long, quality int")
    assert quality.scored(docs, odd).count() == docs.count()


def test_rejected_documents_go(spark, labels):
    docs = documents(spark, "/root/testdata/sf0.01").selectExpr("*", "'x' as score")
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.predicted for r in quality.scored(docs, labels).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in scores.items() if v == 1)


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit(x, y)
    assert {(a, b) for a, b, *_ in model.pairs} >= {(0, 1)}
    test = rng.uniform(-1, 1, (2000, 3))
    assert np.mean((model.score(test) >= 0.5) == (test[:, 0] * test[:, 1] > 0)) > 0.9


def test_a_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    model = quality.fit(x, (x[:, 2] > 0.3).astype(float))
    for row in x[:20]:
        total = model.intercept + sum(
            t[np.searchsorted(e, v, side="right")] for e, t, v in zip(model.edges, model.tables, row, strict=True)
        )
        for a, b, first, second, table in model.pairs:
            total += table[np.searchsorted(first, row[a], side="right"), np.searchsorted(second, row[b], side="right")]
        assert model.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_one_label_only():
    assert quality.fit(np.ones((5, 2)), np.ones(5)).score(np.ones((1, 2)))[0] > 0.8
