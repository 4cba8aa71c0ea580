"""Exact top-k against brute force with Python's integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroom.llm import topk

ASKS = "vec_id % 50 = 0"


def brute(rows, k=5):
    vectors = {(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows}
    out = []
    for i in sorted({i for i, _ in vectors if i % 50 == 0}):
        scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for q, v in vectors if q == i
                  for j, w in vectors if j != i and len(v) == len(w)]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, list(v), 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = topk.top_k(df.repartition(5), F.expr(ASKS), **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = topk.top_k(df, F.expr(ASKS)).collect()
    assert sorted(map(tuple, got)) == brute([(r.vec_id, r.embedding) for r in df.collect()])


@pytest.mark.parametrize(("group", "part", "per"), [(3, 40, 20), (1024, 16384, 500)])
def test_cells_groups_and_slices_lose_nothing(spark, monkeypatch, group, part, per):
    monkeypatch.setattr(topk, "GROUP", group)
    monkeypatch.setattr(topk, "SLICE", part)
    monkeypatch.setattr(topk, "PER_PIVOT", per)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 4)) * 20
    rows = [(i, tuple((centres[i % 6] + rng.normal(size=4) * 0.3 * (1 + i % 3)).tolist())) for i in range(600)]
    rows += [(1000 + i, (1.5, 1.5, 1.5, 1.5)) for i in range(300)]
    check(spark, rows)


def test_few_rows_ties_and_lengths(spark):
    check(spark, [(0, (1.0, 2.0)), (50, (1.0, 2.0)), (7, (1.0, 2.0)), (8, (0.0, 0.0)), (100, (3.0,)), (9, (-0.1,))])
    check(spark, [(0, (1.0,))])
    check(spark, [(0, (1.0,)), (0, (1.0,)), (1, (0.5,)), (1, (0.5,))])


def test_numbers_beyond_doubles(spark):
    check(spark, [(i, (float(2**22 + i), float(i % 3 - 1) / 256, float(3**13))) for i in range(0, 120, 10)])


def test_edges(spark):
    rows = [
        (0, [1.0, 1.0], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [math.nan, 1.0], 1), (4, [math.inf, 1.0], 1),
        (None, [1.0, 1.0], 1), (50, [], 1), (6, [], 1), (5, [0.5, 0.5], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit("x") for c in ("vector", "score", "rank", "raw", "dim", "cell", "unit")}
    )
    assert sorted(map(tuple, topk.top_k(df, F.expr(ASKS)).collect())) == [(0, 1, 5, 65536)]
    assert topk.top_k(df.limit(0), F.expr(ASKS)).count() == 0


def test_scores_that_leave_the_long_range_are_held():
    big = np.array([[2**62, 2**62]])
    assert topk.exact_scores(big, big)[0, 0] == topk.LARGEST


def test_own_rows_push_out_no_neighbours(spark, monkeypatch):
    """A query's id with many vectors that lie nearest to it, in one cell and in several."""
    monkeypatch.setattr(topk, "PER_PIVOT", 20)
    rng = np.random.default_rng(5)
    own = [(50, v) for v in (rng.normal(size=(40, 3)) * 0.1 + 9).tolist()]
    check(spark, own + [(1000 + 2 * i + 1, v) for i, v in enumerate(rng.normal(size=(120, 3)).tolist())])
    best = topk.Best(np.array([50]), np.array([[1, 0]]), 2)
    best.add(np.array([50, 50, 50, 50, 1, 2, 3]), np.array([[9, 0], [8, 0], [7, 0], [6, 0], [3, 0], [2, 0], [1, 0]]))
    assert best.found.tolist() == [1, 2]
