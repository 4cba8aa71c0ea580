"""The operators as queries over the tables of one folder, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm import (
    ann, centroids, html_text, licenses, mixing, packing, private, quality, secrets, simhash, substrings, topk, turns,
)
from tallyroom.llm.common import table


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), limit=2048)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"), length=100)


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turns.Repair(turns.damaged(conversations)).conversations(everyone=conversations)


def op12_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.scanned(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clustered(table(spark, sf_dir, "embeddings"), k=8, rounds=10, width=64, scale=1024, seed="3")
    return centroids.reported(found)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_ann, op2_simhash, op3_mixing, op4_licenses, op5_html_text, op6_secrets, op7_quality, op8_topk, op9_packing,
        op10_substrings, op11_turns, op12_private, op13_centroids,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mixing": mixing.SQL, "op8_topk": topk.SQL, "op11_turns": turns.SQL, "op13_centroids": centroids.sql(),
    }
