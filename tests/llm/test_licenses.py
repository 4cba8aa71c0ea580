"""License scans against a plain reading of the contract, and planted notices."""

from __future__ import annotations

import re

from llm_cases import documents, edge_docs, no_docs

from tallyroom.llm import licenses

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(docs):
    texts = sorted(((r.doc_id, *plain(r.text)) for r in docs.collect()), key=str)
    rows = licenses.scanned(docs).collect()
    assert sorted((tuple(r)[:6] for r in rows), key=str) == texts
    for r in rows:
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))
    return {r.doc_id: r for r in rows}


def made(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)


def test_documents(spark):
    check(documents(spark, "/root/testdata/sf0.01"))


def test_edges(spark):
    check(edge_docs(spark, "words string, labels int, key string, joined string"))
    assert licenses.scanned(no_docs(spark)).count() == 0


def test_phrases_side_by_side_and_odd_letters(spark):
    check(
        made(
            spark, "MIT License mit license,MIT-LICENSE", "cc by cc by-sa", "xmit license", "Apache\x00License",
            "GNU general PUBLIC license", "apache licenſe", "mİt license K", "éapache license", "mit", "license",
        )
    )


def test_notices_are_found_in_place(spark):
    filler = "some words of the text and the rest of it " * 50
    bodies = {label: body for label, (body, _) in licenses.TEMPLATES.items()}
    got = check(made(spark, *[f"{filler} {b} {filler}" for b in bodies.values()]))
    for i, label in enumerate(bodies):
        assert label in got[i].labels.split(","), label
        assert got[i].score > 0.9


def test_words_out_of_place_are_no_notice(spark):
    body = licenses.TEMPLATES["bsd"][0].split()
    got = check(made(spark, " ".join(body[::-1]), "permission is granted", "rights reserved all", filler := "license " * 40))
    assert filler and all(r.labels == "" and r.score == 0 for r in got.values())


def test_a_changed_notice_still_counts(spark):
    body = licenses.TEMPLATES["mit-notice"][0].replace("merge, publish", "merge them, publish").replace("limitation", "limit")
    got = check(made(spark, f"Copyright someone. {body}"))
    assert got[0].labels == "mit-notice" and 0.7 < got[0].score < 1
