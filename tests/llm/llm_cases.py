"""Inputs that every operator must stand: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def edge_docs(spark, clashing: str = "score double, size string"):
    """Documents with every awkward case, and extra columns that clash with result names."""
    long = " ".join(f"word{i % 997} passage{i % 13}," for i in range(30_000))
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \t\n\r ", None, "a", 5),
        (None, "a text without an id, a text", "en", "b", 3),
        (None, None, None, None, None),
        (4, long, "en", "b", len(long)),
        (5, "Same words here and there, twice over. Été \U0001f600 K", "fr", "c", 9),
        (5, "Same words here and there, twice over. Été \U0001f600 K", "fr", "c", 9),
        (6, "Same words here and there, twice over. Été \U0001f600 K", "fr", "c", 9),
        (7, "one", "de", "a", 3),
        (8, "  two   spaces\n\n and\x0b\x0cbreaks  ", "de", "a", 3),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for field in filter(None, clashing.split(", ")):
        name, kind = field.split(" ")
        docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, sf_dir=SMALL):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
