"""Base spans against the contract's patterns; the field against enumeration, and on finds written in other ways."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from llm_cases import documents, edge_docs, no_docs

from tallyroom.llm import private

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def passes_luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(sum(map(int, str(d))) for d in doubled) % 10 == 0


def plain(text):
    out, counts = [], []
    for kind, pattern in PATTERNS:
        spans = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and passes_luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            spans += [f"{kind}:{m.start()}:{m.end()}"] if good else []
        out += spans
        counts.append(len(spans))
    return (*counts, hashlib.sha256(",".join(out).encode()).hexdigest()), out


def check(docs):
    rows = private.scanned(docs).collect()
    assert rows == [] or list(rows[0].asDict()) == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    expected = sorted(((r.doc_id, *plain(r.text)[0]) for r in docs.collect()), key=str)
    assert sorted((tuple(r)[:6] for r in rows), key=str) == expected
    return rows


def test_base_spans_of_any_text():
    rng = random.Random(2)
    parts = ["@", ".", "a", "b.c", "1", "255", "256", "0", "+", "-", " ", "(", ")", "4111111111111111", "é", "\n", "_%",
             "x@y.z", "1.2.3.4", "+1 (743) 555-3824", "00", "@@", "q@w.e.r-t"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        found = [f"{private.KINDS[k]}:{a}:{b}" for k, a, b in private.base_spans(text)]
        assert found == plain(text)[1], text


def test_documents(spark):
    rows = check(documents(spark, "/root/testdata/sf0.01"))
    base = sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)
    spans = sum(len([s for s in r.spans.split(",") if s]) for r in rows)
    assert base > 50 and base <= spans <= base * 1.02  # clean prose has no others


def test_odd_rows(spark):
    check(edge_docs(spark, "n_email string, spans long, base_sha256 long, masked string, pieces string"))
    assert private.scanned(no_docs(spark)).count() == 0
    assert private.without_private(no_docs(spark)).count() == 0


@pytest.fixture(scope="module")
def model():
    rng = random.Random(6)
    samples = []
    for i in range(400):
        n = rng.randrange
        finds = [f"+{n(1, 90)} ({n(200, 999)}) {n(200, 999)}-{n(10000):04}", f"ab{i}.x@mail{n(9)}.example.com",
                 f"{n(256)}.{n(256)}.{n(256)}.{n(256)}", next(c for c in iter(lambda: str(n(10**15, 10**16)), "") if passes_luhn(c))]
        words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 8))) for _ in range(5)]
        samples.append([f"{words[0]} {rng.choice(finds)} {words[1]}, {words[2]}", f"{words[3]}. {rng.choice(finds)}{rng.choice([' .', ', ', '. '])}{words[4]}"])
    return private.fitted(samples)


def spans_of(text, model, base=None):
    base = private.base_spans(text) if base is None else base
    found = private.tokens(text)
    unary = model.unary([private.features(text, t) for t in found])
    for i, label in enumerate(private.observed(found, base)):
        unary[i, label] += private.OBSERVED * (label > 0)
    shares = private.marginals(unary, *private.links(text, found), model)
    return {f"{private.KINDS[k]} {text[a:b]}" for k, a, b in private.field_spans(text, found, shares, base)}


def test_finds_in_other_forms(model):
    assert spans_of("call (743) 555-3824, or 512-555-1234 now", model) == {"phone (743) 555-3824", "phone 512-555-1234"}
    assert spans_of("write to ab77.x (at) mail3.example.com today", model) == {"email ab77.x (at) mail3.example.com"}
    # A base pattern that runs on into the next number finds nothing; the field still does.
    text = "words +1 (826) 555-4081 190.137.223.204 words"
    assert plain(text)[1] == ["ip:24:39"] and spans_of(text, model) == {"phone +1 (826) 555-4081"}


def test_alike_tokens_agree(model):
    """Bare digits are a phone only where the document says so elsewhere, however far away."""
    far = " and so on" * 500
    assert spans_of(f"see 17435553824{far}", model) == set()
    assert spans_of(f"see 17435553824{far} +1 (743) 555-3824", model) == {"phone 17435553824"}
    assert spans_of(f"see 17435553824{far} +1 (743) 555-3825", model) == set()


def test_plain_numbers_are_left_alone(model):
    for text in ("2021-05-06 we paid 1,234.56 for 12 of 100", "12:30, 45%, v1.2.3 (2019) 1990-1999", "order 100200300 #55",
                 "id 1234567890123456 and 999", "pi is 3.14159265358979 and e is 2.71828"):
        assert spans_of(text, model) == set(), text


def test_messages_give_exact_marginals_on_trees(model):
    rng = np.random.default_rng(3)
    unary = rng.normal(size=(6, private.LABELS)) * 2
    chain, skip = [(0, 1), (1, 2), (4, 5)], [(0, 4), (2, 3)]
    shares = private.marginals(unary, chain, skip, model)
    exact = np.zeros_like(shares)
    for labels in itertools.product(range(private.LABELS), repeat=6):
        score = sum(unary[i, k] for i, k in enumerate(labels))
        score += sum(model.chain[labels[a], labels[b]] for a, b in chain)
        score += sum(model.skip[labels[a], labels[b]] for a, b in skip)
        exact[np.arange(6), labels] += np.exp(score)
    assert np.allclose(shares, exact / exact.sum(1, keepdims=True), atol=2e-3)


def test_long_texts_take_linear_time(model):
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "12 " * 100_000, "(at) " * 50_000):
        start = time.perf_counter()
        spans_of(text, model)
        assert time.perf_counter() - start < 30, text[:8]


def test_masked_text(spark):
    texts = ["mail é.ab@x.org or +1 (743) 555-3824!", "plain", None, "1.2.3.4, 4111111111111111"]
    docs = spark.createDataFrame(
        [(i, t, len(t or ""), "s") for i, t in enumerate(texts)], "doc_id long, text string, n_chars int, spans string"
    )
    rows = {r.doc_id: r for r in private.without_private(docs).collect()}
    assert rows[1].text == "plain" and rows[2].text is None and rows[3].text == "[ip], [card]"
    assert rows[0].text.endswith("or [phone]!") and "ab@x" not in rows[0].text
    assert all(r.spans == "s" and r.n_chars == len(r.text or "") for r in rows.values())
    assert list(rows[0].asDict()) == docs.columns


def test_reruns_agree(spark):
    docs = documents(spark)
    first = private.learnt(docs)
    again = private.learnt(docs.repartition(5))
    assert first.rows == again.rows and np.array_equal(first.weights, again.weights)
