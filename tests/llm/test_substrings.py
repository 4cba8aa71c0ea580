"""Repeated byte strings against brute force; suffix order and common prefixes against sorted suffixes."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, edge_docs, no_docs

from tallyroom.llm import induced, substrings


def brute(rows, length):
    """Rows of (key, text), each text in the order of its key; equal rows are one document."""
    seen = set()
    out = {}
    for key, text in sorted(set(rows)):
        body = (text or "").encode()
        gone = np.zeros(len(body) + 2, bool)
        for i in range(len(body) - length + 1):
            string = body[i : i + length]
            if string in seen:
                gone[i + 1 : i + 1 + length] = True
            seen.add(string)
        kept = bytes(b for b, g in zip(body, gone[1:-1], strict=True) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out[key, text] = (key, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out[r] for r in rows)


def check(spark, rows, length, gram):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substrings.deduplicated(docs, length=length, gram=gram)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows, length)


def test_documents(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = brute(rows, 100)
    assert sorted(map(tuple, substrings.deduplicated(docs).collect())) == expected
    assert any(r[2] for r in expected)


@pytest.mark.parametrize("hot", [3, 16_384])
def test_made_texts(spark, monkeypatch, hot):
    """Copies, near copies, a passage all share, periodic texts; with hot anchors and without."""
    monkeypatch.setattr(substrings, "HOT", hot)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(12), prose(40)
    texts = [f"{prose(8)} {passage} {prose(8)}" for _ in range(25)]
    texts += [base, base, base[:50] + "X" + base[51:], base[20:], base[5:90] + base[30:]]
    texts += ["ab" * 60, "ab" * 61, "a" * 90, "aab" * 30, "short", "", "a" * 12 + "b" + "a" * 13]
    ids = rng.sample(range(1000), len(texts))
    check(spark, list(zip(ids, texts, strict=True)), 12, 5)


def test_no_unit_gets_all_places_of_a_hot_string(spark, monkeypatch):
    """A passage in different contexts: its strings must not meet in one unit, however many documents have it."""
    monkeypatch.setattr(substrings, "HOT", 20)
    most = []
    settle = substrings._settle

    def counted(snippets, *rest):
        most.append(max([r["count"] for r in snippets.groupBy("unit", "key").count().collect()], default=0))
        return settle(snippets, *rest)

    monkeypatch.setattr(substrings, "_settle", counted)
    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = prose(20)
    rows = [(i, prose(30) + passage + prose(30)) for i in range(200)]
    check(spark, rows + rows[:9] + [(900, rows[5][1])], 16, 6)
    assert max(most) <= 20


def test_edges(spark):
    docs = edge_docs(spark, "doc string, print long, key long, spans string, text_ long")
    rows = substrings.deduplicated(docs).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted((r.doc_id for r in docs.collect()), key=str)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].kept_sha256 == hashlib.sha256(b"").hexdigest() and by_id[1].n_bytes == 0
    assert by_id[4].n_removed > 0
    assert substrings.deduplicated(no_docs(spark)).count() == 0


def test_equal_keys_and_null_keys(spark):
    text = "the same text in several rows, long enough to count as a repeat"
    rows = [(1, text), (1, text), (None, text), (None, "other " + text), (0, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substrings.deduplicated(docs, length=20, gram=8).collect()
    # Equal rows are one document, and the first with the text; rows without a key come last.
    assert sorted(r.n_removed for r in got if r.doc_id is not None) == [0, 0, 0]
    assert sorted(r.n_removed for r in got if r.doc_id is None) == [len(text), len(text)]


@pytest.mark.parametrize("clash", [False, True], ids=["keys tell texts", "a key with two texts"])
def test_a_row_repeated_many_times(spark, clash):
    """The copies of a row have the result and the list of spans of one."""
    rng = random.Random(11)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = prose(40)
    rows = [(1, prose(60) + passage + prose(9)), (7, prose(30) + passage + prose(50) + passage), (9, prose(80))]
    rows += [(None, prose(20) + passage), (None, passage + prose(30))] + ([(9, passage)] if clash else [])
    check(spark, [r for r in rows if r[0] is not None], 16, 6)
    docs = [spark.createDataFrame(r, "doc_id long, text string") for r in (rows, rows + [rows[1]] * 300)]
    once, often = (substrings.deduplicated(d.repartition(6), length=16, gram=6).collect() for d in docs)
    assert sorted(map(str, set(once))) == sorted(map(str, set(often))) and len(often) == len(once) + 300
    assert all(r.n_removed for r in once if r.doc_id is None)
    lists = []
    for d in docs:
        texts = d.selectExpr("doc_id as doc", "xxhash64(text) as print", "cast(text as binary) as text").filter("doc = 7")
        earlier = d.selectExpr("0L as doc", "0L as print", f"cast('{passage}' as binary) as text").limit(1)
        found = substrings.gathered(substrings.spans(texts.union(earlier), 16, 6)).filter("doc = 7").first()
        lists.append(sorted(map(tuple, found.spans)))
    assert lists[0] == lists[1]


def test_a_text_longer_than_a_chunk(spark):
    """Strings of a long text, hashed alone, meet those of short texts, hashed together."""
    rng = random.Random(5)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    long = prose(2 * substrings.CHUNK + 9)
    rows = [(2, long), (5, prose(70) + long[150_000:150_300] + prose(30)), (1, long[-200:]), (3, "")]
    check(spark, rows, 100, 24)


def test_anchors_are_found_in_parts_that_fit_a_cache():
    """Eight bytes for each of a batch of texts, several times over, fall out of the cache: that took twice the time."""
    rng = np.random.default_rng(2)
    texts = [rng.integers(32, 122, 3000).astype(np.uint8).tobytes() for _ in range(1400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)))] * 2 + [pa.array(texts)], names=["doc", "print", "text"])
    tracemalloc.start()
    for part in substrings._chunks(iter([batch]), 2):
        substrings.anchors(*substrings._end_to_end(part.column(2)), 100, 24)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 16 << 20


def test_the_first_pass_sends_only_keys(spark):
    docs = documents(spark).selectExpr("doc_id as doc", "0L as print", "cast(coalesce(text, '') as binary) as text")
    keys = substrings.anchor_keys(docs, 100, 24)
    assert keys.columns == ["key"]
    every = substrings.anchored(docs, 100, 24).select("key")
    assert sorted(r.key for r in keys.collect()) == sorted(r.key for r in every.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.lists(st.tuples(st.integers(0, 29), st.integers(0, 29)), max_size=5)), max_size=6))
def test_merged_spans_cover_what_the_spans_do(texts):
    sizes = [n for n, _ in texts]
    spans = [[(min(a, b) % n, min(a, b) % n + 1 + (max(a, b) % (n - min(a, b) % n))) for a, b in s] for n, s in texts]
    gone = [[any(a <= i < b for a, b in s) for i in range(n)] for n, s in zip(sizes, spans, strict=True)]
    begin, end = (np.array([x[k] for s in spans for x in s], np.int64) for k in (0, 1))
    first, last = substrings.merged(begin, end, np.array([len(s) for s in spans], np.int64), np.cumsum(sizes).astype(np.int64))
    at, expected = 0, []
    for g in gone:
        edges = np.flatnonzero(np.diff(np.r_[False, g, False].astype(int)))
        expected += [(at + a, at + b) for a, b in edges.reshape(-1, 2).tolist()]
        at += len(g)
    assert list(zip(first.tolist(), last.tolist(), strict=True)) == expected


letters = st.lists(st.integers(0, 3), max_size=120) | st.lists(st.integers(0, 3000), max_size=60)


@settings(max_examples=150, deadline=None)
@given(letters, st.integers(1, 3))
def test_suffix_order_and_prefixes(values, times):
    values = values * times
    text = np.array(values, np.int64)
    order = induced.suffix_order(text)
    assert order.tolist() == sorted(range(len(values)), key=lambda i: values[i:])
    if len(values):
        shared = induced.permuted_prefixes(text, order, 20)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
            n = 0
            while n < 20 and a + n < len(values) and b + n < len(values) and values[a + n] == values[b + n]:
                n += 1
            assert shared[b] == n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60).map(str.encode) | st.just(b"ab" * 30), max_size=6))
def test_every_string_has_one_anchor_that_follows_from_it(texts):
    length, gram = 11, 4
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
    key, place, low, high, _ = substrings.anchors(data, ends, length, gram)
    of_string, covered = {}, np.zeros(len(data) + 1, int)
    for k, p, a, b in zip(key.tolist(), place.tolist(), low.tolist(), high.tolist(), strict=True):
        for s in range(a, b + 1):
            covered[s] += 1
            assert of_string.setdefault(data[s : s + length].tobytes(), (k, p - s)) == (k, p - s)
    start = 0
    for t in texts:
        for i in range(len(t)):
            assert covered[start + i] == (i + length <= len(t))
        start += len(t)
