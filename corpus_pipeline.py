"""A corpus from documents to packed training sequences.

Documents that the quality classifier rejects go; of each group of near
duplicates one stays; secrets are taken out of the texts; sources are mixed to
their target weights, some documents repeated and some left out; the rest is
cut and packed into sequences of tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyroom.llm import mixing, packing, quality, secrets, simhash
from tallyroom.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_duplicates(docs, shingle=4, radius=4)


def secrets_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, weights=(5, 2, 1), most=3)


def sequences_packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, limit=2048)


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_of_each_group),
    ("secret scan", secrets_removed),
    ("source mixing", sources_mixed),
    ("best-fit packing", sequences_packed),
]

#: Training a model, tokens and packing are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all of ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
