"""Relations that several reports read: computed once, written, removed after their last reader.

A lazy DataFrame is computed anew by every report over it. Inside the ``with``
block of these functions it is a table on storage that all executors share,
so neither later reports nor lost executors compute it again. The block states
its life: run or write the reports inside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tallyroom.session import remove_path, scratch_path


@contextmanager
def stored_relation(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows of ``df`` as parquet below ``spark.checkpoint.dir`` until the block ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


@contextmanager
def bucketed_relation(df: DataFrame, name: str, by: Sequence[str], buckets: int) -> Iterator[DataFrame]:
    """The rows of ``df`` as a table of the warehouse, bucketed and sorted by ``by``, until the block ends.

    Tables with equal buckets join and group by those columns without a
    shuffle. The rows are dealt by the same hash before they are written, so
    each bucket is one file. A key with more rows than a task should read does
    not belong in buckets: pre-aggregate first, as the callers here do.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    try:
        (
            df.repartition(buckets, *by)
            .write.bucketBy(buckets, *by)
            .sortBy(*by)
            .format("parquet")
            .saveAsTable(table)
        )
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS `{table}`")
