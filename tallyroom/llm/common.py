"""What the operators share: written tables, code for the executors, per-row Python over Arrow."""

from __future__ import annotations

import atexit
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyroom.session import scratch_path

PACKAGE = Path(__file__).resolve().parent.parent

#: The white space that separates words, as contracts spell it.
SPACES = "\x20\x09-\x0d"
WORD = rf"[^{SPACES}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_tallyroom_shipped", False):
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, Path(PACKAGE.name) / file.relative_to(PACKAGE))
    path = scratch_path(spark, "code") + "/tallyroom_code.zip"
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
    stream.write(archive.getvalue())
    stream.close()
    context.addPyFile(path)
    context._tallyroom_shipped = True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table, wherever Spark keeps it; a stopped session leaves it to the cluster."""
    try:
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # noqa: BLE001  the gateway may be gone at exit
        return


def write_table(df: DataFrame, name: str) -> str:
    """Write to a fresh folder below ``spark.checkpoint.dir`` and return its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    atexit.register(remove, df.sparkSession, path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows read from a written table: later steps do not depend on lost executors."""
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, name))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that ``df`` has already, in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def schema_of(df: DataFrame, columns: Iterable[str], extra: str) -> T.StructType:
    """The named columns of ``df`` and then the fields that ``extra`` declares."""
    kept = [df.schema[c] for c in columns]
    return T.StructType([*kept, *T.StructType.fromDDL(extra).fields])


def map_texts(
    df: DataFrame,
    keep: list[str],
    inputs: list,
    extra: str,
    make: Callable[[], Callable[..., dict[str, list]]],
) -> DataFrame:
    """Per-row Python: the ``keep`` columns, then the columns declared in ``extra``.

    ``make`` is called once per task and gives a function from lists (one per
    expression of ``inputs``) to lists (one per declared column). Rows pass in
    Arrow batches, so memory is bounded by a batch, not by the task.
    """
    ship(df.sparkSession)
    schema = schema_of(df, keep, extra)
    arrow = to_arrow_schema(schema)
    made = [f.name for f in schema.fields[len(keep) :]]
    kept, taken = len(keep), len(inputs)
    # Positions, not names: columns may clash with names of ours.
    columns = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    columns += [c.alias(f"x{i}") for i, c in enumerate(inputs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for part in slices(batch):
                result = each(*[part.column(kept + i).to_pylist() for i in range(taken)])
                arrays = [part.column(i).cast(arrow.field(i).type) for i in range(kept)]
                arrays += [
                    pa.array(result[n], arrow.field(kept + i).type) for i, n in enumerate(made)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, rows: int = 1000, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts, as Python objects take several times the room of Arrow's."""
    if not batch.num_rows:
        return
    each = max(1, min(rows, int(size * batch.num_rows / max(1, batch.nbytes))))
    for start in range(0, batch.num_rows, each):
        yield batch.slice(start, each)


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` for the nodes of undirected ``edges (a, b)`` of longs; root: the smallest node reachable.

    Alternating large-star and small-star passes. Each is a minimum per node,
    combined before its shuffle, and a join, whose hot nodes Spark splits; no
    neighbourhood is ever gathered. Every pass is a written table.
    """
    spark = edges.sparkSession

    def star(pairs: DataFrame, both: bool) -> DataFrame:
        # Directed from a node to its neighbours: all, or the smaller ones.
        out = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        if both:
            out = out.union(out.select("v", "u").toDF("u", "v"))
        least = out.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        linked = out.join(least, "u")
        if both:
            linked = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            linked = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return linked.filter("a <> b").distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    path = write_table(edges.select("a", "b").filter("a <> b").distinct(), name)
    current = spark.read.schema("a long, b long").parquet(path)
    before = None
    while True:
        following = write_table(star(star(current, True), False), name)
        remove(spark, path)
        path, current = following, spark.read.schema("a long, b long").parquet(following)
        now = state(current)
        if now == before:
            break
        before = now
    # Stars: every edge leads from a node to its root.
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def in_units(
    rows: DataFrame, unit: str, order: list[str], parts: int, make: Callable[[], Callable], schema: str
) -> DataFrame:
    """Imperative work on sorted runs of rows: ``make()`` gives ``each(unit, batch) -> list of output batches``.

    The rows of a ``unit`` (a long) arrive in ``order``, in one task, batch by
    batch, so a unit may be larger than memory. After its last row ``each`` is
    called with None.
    """
    ship(rows.sparkSession)
    at = rows.columns.index(unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        open_ = None
        for batch in batches:
            units = batch.column(at).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(units[1:] != units[:-1]) + 1).tolist(), len(units)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if open_ is not None and open_ != units[a]:
                    yield from each(open_, None)
                open_ = units[a]
                yield from each(open_, batch.slice(a, b - a))
        if open_ is not None:
            yield from each(open_, None)

    return rows.repartition(max(1, parts), unit).sortWithinPartitions(unit, *order).mapInArrow(run, schema)


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    """An array column whose arrays have one length, as rows of a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(kind, copy=False)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest scores of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
