"""Clustering against a plain version with Python's integers, and against SQL."""

from __future__ import annotations

import hashlib
import math
from pathlib import Path

import numpy as np
import pytest
from compare import differences, duck

from tallyroom.llm import centroids

FOLDER = "/root/testdata/sf0.01"


def plain(rows, k=8, rounds=10, width=64, scale=1024):
    kept = [
        (i, [math.floor(scale * x) if abs(x) < 1e300 else int(x) * scale for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    at = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(at)) for _, v in kept]

    for _ in range(rounds):
        found = assign() if at else []
        for n in range(len(at)):
            own = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == n]
            if own:
                at[n] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign() if at else []
    sums = {n: sum(d for d, c in found if c == n) for n in range(len(at))}
    total = sum(sums.values())

    def fit(x):
        return x if x < 2**63 else None

    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(
        ((i, c, fit(d), fit(sums[c]), fit(total), shas[c]) for (i, _), (d, c) in zip(kept, found, strict=True)), key=str
    )


def check(spark, rows, kind="double", **options):
    data = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster int, key string"
    )
    got = centroids.reported(centroids.clustered(data.repartition(3), **options))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    stored = [(r.vec_id, r.embedding) for r in data.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == plain(stored, **options)


def blobs(n, width, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width)) * 3
    return [(i, (centres[i % 5] + rng.normal(size=width) * 0.4).tolist()) for i in range(n)]


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no driver tables here")
def test_embeddings_against_sql(spark):
    from tallyroom.llm.queries import op13_centroids

    con = duck({"embeddings": f"{FOLDER}/embeddings.parquet"})
    assert not differences(op13_centroids(spark, FOLDER), con, centroids.sql())


def test_blobs_of_floats(spark):
    check(spark, blobs(300, 6), "float", width=6, rounds=4)


def test_odd_rows(spark):
    rows = blobs(40, 4)
    rows += [(100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0, None, 0.0, 0.0]), (104, [1.0, math.nan, 0.0, 0.0])]
    rows += [(105, [math.inf, 0.0, 0.0, 0.0]), (None, [0.5, 0.5, 0.5, 0.5]), (3, [0.0] * 4), (3, [0.0] * 4)]
    rows += [(106, [-0.0001, 0.0, 5e-324, -5e-324])]
    check(spark, rows, width=4, rounds=3)


def test_repeats_ties_and_few_rows(spark):
    check(spark, [(i, [1.0, 2.0]) for i in range(30)], width=2)
    check(spark, [(7, [1.0, 2.0])] * 12 + [(8, [3.0, 2.0]), (9, [2.0, 2.0])], width=2)
    check(spark, [(i, [float(i % 2 * 2), 0.0]) for i in range(20)] + [(50 + i, [1.0, 0.0]) for i in range(9)], width=2)
    check(spark, [(1, [1.0]), (2, [5.0])], width=1)


def test_no_vectors(spark):
    check(spark, [])
    check(spark, [(1, [1.0])])


def test_numbers_beyond_longs(spark):
    rows = [(i, [1e30 * (i % 3), -1e-3 * i, 2.0**40]) for i in range(20)] + [(90, [1.7e308, -1.7e308, 0.0])]
    check(spark, rows, width=3, rounds=3)
    check(spark, [(i, [float(2**17 + i * 3 % 7), -(2.0**17)]) for i in range(30)], width=2, rounds=3)


def test_bounds_hold_and_rule_out(spark):
    """No bound exceeds a true distance, and most comparisons are saved on clustered vectors."""
    x = centroids.whole(np.array([v for _, v in blobs(2000, 16, 4)]), 1024)
    pivots = x[:8].tolist()
    at = [x[i::5].mean(0).astype(int).tolist() for i in range(5)] + pivots[:3]
    nearest = centroids.Nearest(at, pivots)
    kept = centroids.distances(x, np.array(pivots))
    true = centroids.distances(x, np.array(at))
    low = nearest.bounds(kept)
    assert (low <= true * (1 + 1e-12)).all()
    cluster, best, work = nearest.assign(x, kept)
    assert (best == np.rint(true.min(1) ** 2)).all() and (cluster == true.argmin(1)).all()
    assert work < 0.6 * len(x) * len(at)


def test_sums_in_digits():
    for value in (0, 1, -1, 2**40, -(2**40), 2**200 + 17, -(2**1034) - 5, 2**63 - 1):
        found = centroids.digits(value)
        assert sum(d << centroids.DIGIT * i for i, d in enumerate(found)) == value
        assert all(abs(d) <= 1 << centroids.DIGIT for d in found)
