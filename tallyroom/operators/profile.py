"""Table profiles: missing values, keys, distinct values, frequencies."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.functions.numbers import rounded_even
from tallyroom.functions.text import case_style


def any_null(columns: Iterable[str]) -> Column:
    return reduce(or_, [F.col(f"`{c}`").isNull() for c in columns])


def preview(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order, NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def with_total(df: DataFrame, of: DataFrame) -> DataFrame:
    """``df`` with the row count of another table beside every row."""
    return df.withColumn("total_rows", of.agg(F.count("*")).scalar())


def null_row_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(F.count_if(any_null(columns)).alias("row_count"))


def filled_among_incomplete(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Among rows lacking any of the columns: how many hold each one."""
    return df.filter(any_null(names)).agg(
        *[F.sum(F.when(F.col(c).isNotNull(), 1).otherwise(0)).alias(n) for c, n in names.items()]
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table listing with the number of rows of each."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of one catalog database."""
    return (
        spark.sql("SHOW TABLES IN IDENTIFIER(:db)", args={"db": database})
        .filter(~F.col("isTemporary"))
        .select(F.col("tableName").alias("table_name"))
    )


def _per_column(
    df: DataFrame, entry: Callable[[T.StructField, Column], list[Column]], **more: Column
) -> DataFrame:
    """One row per column, from one pass over the table.

    ``entry`` builds a column's row from its field and its non-NULL count; it
    may use ``rows``, the table's length, and the aggregates in ``more``.
    """
    totals = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)],
        *[value.alias(name) for name, value in more.items()],
    )
    rows = [
        F.struct(*entry(field, F.col(f"n{i}"))) for i, field in enumerate(df.schema.fields)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def column_catalogue(df: DataFrame, table_name: str) -> DataFrame:
    """Name, type and key flag of every column.

    Parquet declares no constraints, so a column counts as a key when it has no
    NULL and no repeated value. One pass first rules out the columns that have
    a NULL, or whole numbers or days in a range smaller than the table, which
    must repeat. Only the columns left are counted, in one shuffle of (column,
    value) counts. Nothing runs before the result is asked for.
    """
    # By position: a name may hold a dot.
    place = {f.name: i for i, f in enumerate(df.schema.fields)}
    spans = {f"span_{place[f.name]}": span for f in df.schema.fields if (span := _span(f)) is not None}

    def row(field: T.StructField, filled: Column) -> list[Column]:
        possible = filled == F.col("rows")
        if f"span_{place[field.name]}" in spans:
            # An empty table has no span, and every column of it is a key.
            roomy = F.col(f"span_{place[field.name]}") >= F.col("rows")
            possible = possible & F.coalesce(roomy, F.lit(True))
        return [
            F.lit(table_name).alias("table_name"), F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"), possible.alias("possible"),
        ]

    listed = _per_column(df, row, **spans)
    flags = listed.agg(F.collect_set(F.when(F.col("possible"), F.col("column_name"))).alias("left")).scalar()
    pairs = [
        F.when(
            F.array_contains("left", F.lit(c)),
            F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("value")),
        )
        for c, i in place.items()
    ]
    values = df.select(*[F.col(f"`{c}`").cast("string").alias(f"v{i}") for c, i in place.items()], flags.alias("left"))
    repeats = (
        values.select(F.inline(F.array(*pairs)))
        .filter(F.col("column_name").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
        .groupBy("column_name")
        .agg((F.max("n") == 1).alias("unique"))
    )
    return listed.join(repeats, "column_name", "left").select(
        "table_name", "column_name", "data_type", F.coalesce("unique", "possible").alias("is_key")
    )


def _span(field: T.StructField) -> Column | None:
    """How many different values a column's range has room for, if countable."""
    low, high = F.min(f"`{field.name}`"), F.max(f"`{field.name}`")
    if isinstance(field.dataType, T.IntegralType):
        wide = "decimal(38,0)"
        return high.cast(wide) - low.cast(wide) + 1
    if isinstance(field.dataType, T.DateType):
        return F.datediff(high, low) + 1
    return None


def frame_info(df: DataFrame) -> DataFrame:
    """Non-NULL count and type per column."""
    return _per_column(
        df,
        lambda field, filled: [
            F.lit(field.name).alias("column_name"),
            filled.alias("non_null"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
        ],
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage per column."""

    def row(field: T.StructField, filled: Column) -> list[Column]:
        missing = F.col("rows") - filled
        share = missing * 100.0 / F.nullif(F.col("rows"), F.lit(0))
        return [
            F.lit(field.name).alias("column_name"),
            missing.alias("missing"),
            rounded_even(share, 2).alias("missing_pct"),
        ]

    return _per_column(df, row)


def name_styles(df: DataFrame) -> DataFrame:
    """Letter-case style of every column name, with its non-NULL count."""
    return _per_column(
        df,
        lambda field, filled: [
            F.lit(field.name).alias("column_name"),
            filled.alias("non_null"),
        ],
    ).withColumn("style", case_style(F.col("column_name")))


def _distinct_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (column_name, value) pairs, values as text; one shuffle."""
    return _as_texts(df, columns).distinct()


def _as_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) of every row and column, values as text."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*pairs)))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of several columns as text, sorted as what they are, missing last.

    Numbers are sorted by value, everything else as text.
    """
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    number = F.when(F.col("column_name").isin(numeric), F.col("value").try_cast("double"))
    exact = F.when(F.col("column_name").isin(numeric), F.col("value").try_cast("decimal(38,10)"))
    return _distinct_pairs(df, columns).orderBy(
        "column_name",
        number.asc_nulls_last(),
        exact.asc_nulls_last(),
        F.col("value").asc_nulls_last(),
    )


def cardinality(df: DataFrame, folds: Mapping[str, str]) -> DataFrame:
    """Distinct values per column, as written and with the case folded.

    ``folds`` maps a column to ``lower`` or ``upper``. Folding works on the
    distinct values, so the table is expanded once per column, not twice.
    """
    name, value = F.col("column_name"), F.col("value")
    lowered = [c for c, fold in folds.items() if fold == "lower"]
    folded = F.when(name.isin(lowered), F.lower(value)).otherwise(F.upper(value))
    spellings = (
        _distinct_pairs(df, list(folds))
        .filter(value.isNotNull())
        .groupBy("column_name", folded.alias("folded"))
        .agg(F.count("*").alias("n"))
    )

    def counts(column: str) -> Column:
        own = name == column
        return F.struct(
            F.lit(column).alias("column_name"),
            F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias("distinct_raw"),
            F.count_if(own).alias("distinct_folded"),
        )

    return spellings.agg(F.array(*[counts(c) for c in folds]).alias("c")).select(
        F.inline("c")
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULLs left out."""
    return df.filter(F.col(f"`{column}`").isNotNull()).groupBy(f"`{column}`").count()


def most_frequent(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; equal counts go by value."""
    return frequencies(df, column).orderBy(F.desc("count"), F.asc(f"`{column}`")).limit(k)
