"""The mixture against its SQL and its contract."""

from __future__ import annotations

import duckdb
import pytest
from llm_cases import SMALL, documents, edge_docs, no_docs
from pyspark.sql import functions as F

from tallyroom.llm import mixing


def oracle(docs):
    connection = duckdb.connect()
    connection.register("documents", docs.select("doc_id", "text", "source").toArrow())
    return connection.execute(mixing.SQL).fetchall()


def check(docs):
    got = mixing.mixture(docs).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, oracle(docs)), key=key)
    return got


def near_target(docs):
    counted, (size, source_size, target, copies) = mixing.with_copies(docs)
    per_source = counted.groupBy("source").agg(
        F.sum(F.col(size) * F.col(copies)).alias("taken"),
        F.first(target).alias("target"),
        F.max(size).alias("largest"),
        F.max(copies).alias("copies"),
    )
    for r in per_source.collect():
        assert abs(r.taken - r.target) <= r.largest / 2 + 1
        assert r.copies <= 3


def test_documents(spark):
    check(documents(spark))
    near_target(documents(spark))


def test_edges(spark):
    docs = edge_docs(spark, "size string, target string, rest long, odds long, copies long, words string")
    check(docs)
    assert mixing.mixture(no_docs(spark)).count() == 0
    assert mixing.mixed(no_docs(spark)).count() == 0


def test_a_hot_source_and_caps(spark):
    docs = documents(spark, "/root/testdata/sf0.01").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 50 == 1, None).otherwise(F.col("source"))
    )
    got = check(docs)
    near_target(docs)
    assert any(r.source_size and abs(r.target - 3 * r.source_size) < 1e-6 for r in got)


def test_blank_texts_only(spark):
    docs = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert {tuple(r) for r in mixing.mixture(docs).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_rows_are_repeated_as_counted(spark):
    docs = edge_docs(spark, "copy long, size string").unionByName(
        documents(spark).withColumns({"copy": F.lit(1).cast("long"), "size": F.lit("x")})
    )
    counted, (size, *_, copies) = mixing.with_copies(docs)
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    assert rows.count() == counted.agg(F.sum(copies)).first()[0]
    again = mixing.mixed(docs.repartition(5))
    assert rows.exceptAll(again).count() == 0 and again.exceptAll(rows).count() == 0


@pytest.mark.parametrize("bins", [2, 1024])
def test_bins_do_not_change_the_sample(spark, monkeypatch, bins):
    expected = sorted(map(tuple, mixing.mixture(documents(spark)).collect()))
    monkeypatch.setattr(mixing, "BINS", bins)
    assert sorted(map(tuple, mixing.mixture(documents(spark)).collect())) == expected


def test_plan_is_native(spark):
    plan = mixing.mixture(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
    assert SMALL in plan
