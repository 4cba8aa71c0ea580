"""SimHash groups against all pairs, on real, edge and dense inputs."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, edge_docs, no_docs

from tallyroom.llm import simhash


def plain_fingerprint(text: str | None) -> int:
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], radius: int) -> list[int]:
    values = np.unique(np.array(prints, np.uint64))
    root = np.arange(len(values))
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius)
        roots = np.unique(root[near])
        root[np.isin(root, roots)] = roots.min()
    return root[np.searchsorted(values, np.array(prints, np.uint64))].tolist()


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    comps = plain_components(prints, 4)
    smallest: dict[int, int] = {}
    for r, c in zip(rows, comps, strict=True):
        if r.doc_id is not None:
            smallest[c] = min(smallest.get(c, r.doc_id), r.doc_id)
    expected = sorted(
        ((r.doc_id, f"{p:016x}", smallest.get(c)) for r, p, c in zip(rows, prints, comps, strict=True)),
        key=str,
    )
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert got == expected
    return got


def test_documents(spark):
    got = check(documents(spark))
    assert len({g[2] for g in got}) < len(got)


def test_edges(spark):
    check(edge_docs(spark, "fingerprint string, component_id long, root long"))
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = edge_docs(spark, "fingerprint string, root long")
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    # Empty texts form one group, the three copies another.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 4, 5, 7, 8, None]


@settings(max_examples=40, deadline=None)
@given(
    st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6),
    st.lists(st.lists(st.integers(0, 63), max_size=6), min_size=1, max_size=40),
    st.integers(0, 8),
)
def test_index_finds_every_close_pair(centres, flips, radius):
    values = {c ^ sum(1 << b for b in set(f)) for c in centres for f in flips}
    codes = np.array(sorted(values), np.uint64)
    bucket = (codes % np.uint64(2)).astype(np.int64)
    order = np.lexsort((simhash.gray_rank(codes), bucket))
    codes, bucket = codes[order], bucket[order]
    found = {
        (int(a), int(b))
        for part in simhash.GrayIndex(codes, bucket).pairs(radius)
        for a, b in zip(*part, strict=True)
    }
    expected = {
        (i, j)
        for i in range(len(codes))
        for j in range(i + 1, len(codes))
        if bucket[i] == bucket[j] and int(codes[i] ^ codes[j]).bit_count() <= radius
    }
    assert found == expected


@pytest.mark.parametrize("bucket", [4, 4096])
def test_crowded_buckets_are_cut_and_lose_no_link(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(3)
    codes = {int(rng.integers(0, 2**63)) for _ in range(30)}
    for c in list(codes):
        for _ in range(6):
            c ^= sum(1 << int(b) for b in rng.choice(63, 3, replace=False))
            codes.add(c)
    rows = [(i, c) for i, c in enumerate(sorted(codes))]
    prints = spark.createDataFrame(rows, "doc_id long, fingerprint long").repartition(5)
    got = {r.fingerprint: r.component_id for r in simhash.grouped(prints).collect()}
    comps = plain_components([c for _, c in rows], 4)
    first: dict[int, int] = {}
    for (i, _), c in zip(rows, comps, strict=True):
        first.setdefault(c, i)
    assert got == {c: first[k] for (_, c), k in zip(rows, comps, strict=True)}
