"""Parquet tables and the domain views derived from them."""

from __future__ import annotations

import re
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession

from tallyroom.sources.view_sql import VIEW_SQL, in_spark

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Stated so that opening a table reads no file footer; the rest are inferred.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

_SOURCE = re.compile(rf"\b(from|join) ({'|'.join(TABLES)})\b")


def table_names(spark: SparkSession, sf_dir: str) -> list[str]:
    """The tables that a data folder holds: its parquet files and folders, wherever Spark reads them."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(name.removesuffix(".parquet") for name in names if name.endswith(".parquet"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Views:
    """The domain views of one data folder as attributes: ``v.tel_users``.

    A view is a lazy DataFrame and registers nothing in the catalog. Tables and
    views are opened once per instance.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._table = cache(partial(table, spark, sf_dir))

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEW_SQL:
            raise AttributeError(name)
        sql = in_spark(VIEW_SQL[name])
        used = {t: self._table(t) for t in {m[2] for m in _SOURCE.finditer(sql)}}
        opened = self._spark.sql(_SOURCE.sub(r"\1 {\2}", sql), **used)
        setattr(self, name, opened)
        return opened
