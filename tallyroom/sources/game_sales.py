"""The sales file: CSV with a header row and several spellings of a missing value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The file's header, and the type each column loads as. Columns
# that mix decimal commas or words into numbers load as text.
HEADER = {
    "Name": "string",
    "Platform": "string",
    "Year of Release": "double",
    "Genre": "string",
    "NA sales": "double",
    "EU sales": "string",
    "JP sales": "string",
    "Other sales": "double",
    "Critic Score": "double",
    "User Score": "string",
    "Rating": "string",
}

# What pandas.read_csv takes as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def read_games_csv(
    spark: SparkSession, path: str, position: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Read every column as text, turn the missing spellings into NULL, then type it.

    Columns are found by the names of the header, in any order; an absent or
    unknown name is an error, as is a file whose header differs from the
    others'. ``position`` names a column to add: the number of a row, from 0,
    by file name and place in the file, the same in every scan.

    A line break inside a quoted field needs ``multi_line``, at the price that
    a file is then read by one task. Without it such a field is an error, never
    two rows.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.csv(path, inferSchema=False, **options).columns
    if sorted(header) != sorted(HEADER):
        wrong = sorted(set(header) ^ set(HEADER)) or header
        raise ValueError(f"the header of {path} is not that of a sales file: {wrong}")
    schema = ", ".join(f"`{name}` string" for name in header)
    # Rows with too few or too many fields fail; all columns are parsed to see them.
    raw = spark.read.option("columnPruning", False).csv(
        path, schema=schema, enforceSchema=False, mode="FAILFAST", **options
    )
    if position:
        raw = _numbered(raw, position)
    typed = [missing_to_null(F.col(f"`{name}`")).cast(kind).alias(name) for name, kind in HEADER.items()]
    return raw.select(*typed, *([position] if position else []))


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows of files numbered by file name, block and place in the block.

    A task numbers its rows in the order of its blocks, so a block's rows are
    consecutive. Where each block's numbers start follows from one row per
    block; no window sees the rows themselves.
    """
    own = F.monotonically_increasing_id()
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    rows = rows.select("*", file.alias("_file"), block.alias("_block"), own.alias("_own"))
    blocks = rows.groupBy("_file", "_block").agg(F.min("_own").alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return (
        rows.join(starts, ["_file", "_block"])
        .withColumn(name, F.col("_start") + F.col("_own") - F.col("_first"))
        .drop("_file", "_block", "_own", "_first", "_start")
    )


def with_file_header(games: DataFrame) -> DataFrame:
    """The snake-case columns under their names in the file."""
    names = {name.replace(" ", "_").lower(): name for name in HEADER}
    return games.withColumnsRenamed(names)


def write_games_csv(games: DataFrame, path: str, position: str = "row_id") -> None:
    """Write a sales table as such files, in the order of ``position``, which is left out.

    Each missing value gets one of four spellings.
    """
    spellings = ["N/A", "nan", "NULL", ""]
    chosen = F.element_at(
        F.array(*[F.lit(s) for s in spellings]), (F.col(position) % 4 + 1).cast("int")
    )
    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), chosen).alias(c) for c in HEADER]
    # The files are named in order, so a reader finds the rows in this order again.
    games.orderBy(position).select(*columns).write.csv(
        path, header=True, emptyValue="", quote='"', escape='"'
    )
