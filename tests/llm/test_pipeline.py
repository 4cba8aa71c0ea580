"""The pipeline against a plain version of each stage."""

from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import SMALL, edge_docs, no_docs
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from tallyroom.llm import mixing, quality, secrets

REAL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(spark, folder):
    """``(doc_id, piece, start, length, ids_crc32)`` of every piece."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.learned(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [r for r in docs.collect()
            if model.score(np.array([quality.features((r.text or "").encode())]))[0] >= 0.3]
    components = plain_components([plain_fingerprint(r.text) for r in rows], 4)
    first = {}
    for r, c in zip(rows, components, strict=True):
        if c not in first or r.doc_id < first[c].doc_id:
            first[c] = r
    ranks = secrets.vocabulary(spark.createDataFrame(list(first.values()), docs.schema))
    longest = max(map(len, ranks))
    texts = []
    for r in first.values():
        base = secrets.base_spans(r.text or "")
        spans = sorted(base + secrets.guess_spans(r.text or "", base, ranks, longest))
        texts.append((r.doc_id, secrets.redacted(r.text, spans) if spans else r.text, r.source))
    connection = duckdb.connect()
    ids, bodies, sources = zip(*texts, strict=True)
    connection.register("documents", pa.table({"doc_id": ids, "text": bodies, "source": sources}))
    by_id = {i: t for i, t, _ in texts}
    pieces = Counter()
    for doc_id, size, _, _, taken in connection.execute(mixing.SQL).fetchall():
        # The copies of a document without words cannot be told from words taken.
        copies = taken // size if size else 0
        tokens = [*REAL.encode(by_id[doc_id] or "", add_special_tokens=False).ids, 0]
        n = len(tokens)
        cuts = [0, *range(n % 2048 or 2048, n + 1, 2048)] if n > 2048 else [0, n]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            pieces[doc_id, i, a, b - a, zlib.crc32(np.array(tokens[a:b], "<u4").tobytes())] += copies
    return +pieces, {i for i, s in ((i, len((t or "").split())) for i, t in by_id.items()) if s}


def test_run_gives_what_the_plain_stages_give(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    expected, with_words = plain(spark, SMALL)
    pieces = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id in with_words)
    assert pieces == expected
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 1


@pytest.mark.parametrize("make", [edge_docs, no_docs])
def test_stages_keep_the_columns(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL)
        if name != "best-fit packing":
            assert result.dtypes == docs.dtypes, name
            docs = result
        result.count()
