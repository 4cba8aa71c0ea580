"""Keys of several columns, and columns that refer to another table's key, found in the data.

Parquet declares no constraints, so both are what holds for all rows at hand.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A sketch has ``2 ** SKETCH`` places; the relative standard deviation that leaves, and how many of them a count may be
#: off before it rules a set out.
SKETCH, ERROR, SURE = 12, 0.017, 6


def unique_sets(df: DataFrame, table_name: str, most: int = 3) -> DataFrame:
    """``table_name, key_columns`` (comma-joined): the least sets of up to ``most`` columns that no two rows share.

    Columns with a NULL take no part. Level by level, one pass sketches the
    distinct values of all sets that contain no smaller key and whose columns
    have enough values between them; only what the sketches cannot rule out is
    counted exactly. The driver receives one row of counts per level and one
    flag per set that is counted. An empty table has the keys of one column.
    """
    names = df.columns
    quoted = {n: F.col("`" + n.replace("`", "``") + "`") for n in names}
    counts = df.agg(F.count("*").alias("rows"), *[F.count(quoted[n]).alias(f"n{i}") for i, n in enumerate(names)]).first()
    rows = counts["rows"]
    full = [n for i, n in enumerate(names) if counts[f"n{i}"] == rows]
    sizes: dict[str, float] = {}
    keys: list[tuple[str, ...]] = []
    for size in range(1, most + 1):
        tried = [s for s in combinations(full, size) if not any(set(k) <= set(s) for k in keys)]
        # Fewer combinations than rows cannot all differ.
        room = [s for s in tried if size == 1 or reduce(float.__mul__, (sizes[n] for n in s)) >= rows]
        if not room:
            continue
        sketches = [
            F.coalesce(
                F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*[quoted[n] for n in s]), F.lit(SKETCH))), F.lit(0)
            ).alias(f"d{i}")
            for i, s in enumerate(room)
        ]
        about = df.agg(*sketches).first()
        if size == 1:
            sizes = {s[0]: about[f"d{i}"] * (1 + SURE * ERROR) + 1 for i, s in enumerate(room)}
        left = [s for i, s in enumerate(room) if about[f"d{i}"] >= rows * (1 - SURE * ERROR)]
        shared = _shared([df.select(*[quoted[n] for n in s]) for s in left])
        keys += [s for i, s in enumerate(left) if i not in shared]
    found = [(table_name, ",".join(k)) for k in keys]
    return df.sparkSession.createDataFrame(found, "table_name string, key_columns string")


def _shared(tables: list[DataFrame]) -> set[int]:
    """The numbers of the tables in which two rows are equal; counts are combined before their shuffle, all in one job."""
    if not tables:
        return set()
    found = []
    for i, df in enumerate(tables):
        same = df.groupBy(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).agg(F.count("*").alias("n"))
        found.append(same.agg(F.max("n").alias("n")).select(F.lit(i).alias("i"), "n"))
    return {r.i for r in reduce(DataFrame.union, found).filter("n > 1").collect()}


def _class(kind: T.DataType) -> str | None:
    """Columns are comparable within whole numbers and within texts."""
    if isinstance(kind, T.IntegralType):
        return "whole"
    return "text" if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)) else None


def references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns all of whose values are values of a key column: ``table_name, column_name, key_table, key_column, same_name``.

    Whole numbers and texts are looked at; a key column has no NULL and no
    repeated value; columns without values refer to nothing. ``same_name`` tells
    likely references from small numbers that happen to be among a key's: the
    names agree behind their first underscore.

    One pass per table gives its distinct values with the column they are in,
    and how often; which columns a value is in follows per value, and from the
    counts of such sets which columns lie within which. No value is compared
    with another column's.
    """
    tagged = []
    for name, df in tables.items():
        columns = [(f.name, _class(f.dataType)) for f in df.schema.fields if _class(f.dataType)]
        parts = [
            F.struct(
                F.lit(name).alias("t"), F.lit(c).alias("c"), F.lit(kind).alias("kind"),
                F.col("`" + c.replace("`", "``") + "`").cast("string").alias("value"),
            )
            for c, kind in columns
        ]
        if parts:
            tagged.append(df.select(F.inline(F.array(*parts))))
    counted = reduce(DataFrame.unionByName, tagged).groupBy("t", "c", "kind", "value").agg(F.count("*").alias("n"))
    # At most one entry per column in a set; NULL values tell that a column is no key.
    place = F.struct("t", "c", (F.col("n") > 1).alias("twice"))
    sets = counted.groupBy("kind", "value").agg(F.array_sort(F.collect_list(place)).alias("places"))
    patterns = sets.groupBy(F.col("value").isNull().alias("missing"), "places").agg(F.count("*").alias("n"))
    each = patterns.select("missing", "n", "places", F.explode("places").alias("a"))
    columns = each.groupBy("a.t", "a.c").agg(
        F.sum(F.when(~F.col("missing"), F.col("n")).otherwise(0)).alias("values"),
        (~F.bool_or(F.col("missing") | F.col("a.twice"))).alias("is_key"),
    )
    both = each.filter("not missing").select("a", "n", F.explode("places").alias("b"))
    within = both.groupBy(*[F.col(f"{x}.{y}").alias(x + y) for x in "ab" for y in "tc"]).agg(F.sum("n").alias("n"))
    own = columns.select(F.col("t").alias("at"), F.col("c").alias("ac"), "values")
    keys = columns.filter("is_key").select(F.col("t").alias("bt"), F.col("c").alias("bc"))
    found = within.join(own, ["at", "ac"]).join(keys, ["bt", "bc"])
    found = found.filter("n = values and not (at = bt and ac = bc)")
    rest = [F.regexp_replace(c, "^[^_]*_", "") for c in ("ac", "bc")]
    return found.select(
        F.col("at").alias("table_name"), F.col("ac").alias("column_name"), F.col("bt").alias("key_table"),
        F.col("bc").alias("key_column"), (rest[0] == rest[1]).alias("same_name"),
    )
