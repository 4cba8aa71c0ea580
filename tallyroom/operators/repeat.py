"""Rows repeated a counted number of times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeat_rows(df: DataFrame, times: Column, chunk: int = 1000) -> DataFrame:
    """Each row as often as ``times`` says; NULL and numbers below one count as one.

    The first ``chunk`` copies are made where the row is. Only rows that need
    more are shuffled: the rest of their copies is dealt out in chunks before
    it is made, one chunk to a task in turn, so the copies of one row spread
    evenly over all tasks, and no array grows beyond ``times / chunk`` or ``chunk`` entries.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    times = F.greatest(F.coalesce(times.cast("long"), F.lit(1)), F.lit(1))
    one, most = F.lit(1).cast("long"), F.lit(chunk).cast("long")

    near = df.select(*columns, F.explode(F.sequence(one, F.least(most, times))).alias("_copy"))

    # A stated number: judged by the size of the rows before they are copied,
    # adaptive execution would merge all tasks into one.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A value known only at run time keeps the filter above ``df``. Pushed into
    # it, the filter would make another plan of it, and the shuffles in ``df``
    # could not be shared by both branches.
    counted = df.select(*columns, (times + F.spark_partition_id() * 0).alias("_times"))
    chunks = F.sequence(one, F.floor((F.col("_times") - 1) / chunk))
    copies = F.least(most, F.col("_times") - F.col("_chunk") * chunk)
    far = (
        counted.filter(F.col("_times") > chunk)
        .select("*", F.explode(chunks).alias("_chunk"))
        .repartitionById(tasks, F.pmod(F.hash(*columns) + F.col("_chunk"), F.lit(tasks)).cast("int"))
        .select("*", F.explode(F.sequence(one, copies)).alias("_copy"))
    )
    return near.select(*columns).union(far.select(*columns))
