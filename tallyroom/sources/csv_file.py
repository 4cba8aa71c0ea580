"""CSV with any header: records cut right in split files, column types inferred by the rules of ``pandas.read_csv``."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What pandas.read_csv takes as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# How whole numbers, numbers and truth values are written.
WHOLE = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"
TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")
MOST_UNSIGNED = 2**64 - 1

#: Rows per group when rows are numbered: no window sees more.
CHUNK = 1 << 16


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def numbered_by_place(rows: DataFrame, name: str) -> DataFrame:
    """Rows of files numbered from 0 by file name, block and place in the block; ``_file`` and ``_block`` are added.

    A task numbers its rows in the order of its blocks, so a block's rows are
    consecutive. Where each block's numbers start follows from one row per
    block; no window sees the rows themselves.
    """
    rows = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_own"),
    )
    blocks = rows.groupBy("_file", "_block").agg(F.min("_own").alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    placed = rows.join(starts, ["_file", "_block"])
    return placed.withColumn(name, F.col("_start") + F.col("_own") - F.col("_first")).drop("_own", "_first", "_start")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``text, _file, _block, _line``: the lines of all files, numbered by file name and place."""
    return numbered_by_place(spark.read.text(path, lineSep="\n").withColumnRenamed("value", "text"), "_line")


def _odd(text: str, quote: str) -> Column:
    """Whether a line opens a quoted field that it does not close, or the other way round."""
    return (F.length(text) - F.length(F.replace(text, F.lit(quote)))) % 2 == 1


def _continued(lines: DataFrame, quote: str) -> DataFrame:
    """``_line, _first``: the lines of records of several lines, and where each such record begins.

    A line with an odd number of quotes opens a quoted field or closes one. How
    many came before is counted within a block and, from one row per block,
    over the blocks of a file; only the places of such lines are moved.
    """
    turns = lines.filter(_odd("text", quote)).select("_file", "_block", "_line")
    blocks = turns.groupBy("_file", "_block").agg(F.count("*").alias("_turns"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_turns").over(before), F.lit(0))).drop("_turns")
    within = Window.partitionBy("_file", "_block").orderBy("_line")
    pairs = (
        turns.withColumn("_turn", F.row_number().over(within))
        .join(blocks, ["_file", "_block"])
        .groupBy("_file", F.floor((F.col("_before") + F.col("_turn") - 1) / 2))
        .agg(F.min("_line").alias("_first"), F.max("_line").alias("_last"), F.count("*").alias("_ends"))
    )
    last = F.when(F.col("_ends") == 2, F.col("_last")).otherwise(
        F.raise_error(F.concat(F.lit("a quoted field never ends: "), F.col("_file")))
    )
    return pairs.select("_first", F.explode(F.sequence("_first", last)).alias("_line"))


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``_file, _line, text``: one row per record, line breaks inside quoted fields kept, blank lines left out.

    ``_line`` is the number of the record's first line among those of all files.
    Files may be cut into any blocks. Only the lines of records of several lines
    are brought together, a record at a time.
    """
    lines = _lines(spark, path)
    members = _continued(lines, quote)
    whole = lines.join(members, "_line", "left_anti").filter(~F.col("text").rlike(r"^[ \t]*\r?$"))
    parts = lines.join(members, "_line").groupBy("_first").agg(
        F.min("_file").alias("_file"), F.array_sort(F.collect_list(F.struct("_line", "text"))).alias("parts")
    )
    joined = parts.select("_file", F.col("_first").alias("_line"), F.array_join("parts.text", "\n").alias("text"))
    both = whole.select("_file", "_line", "text").unionByName(joined)
    return both.withColumn("text", F.regexp_replace("text", r"\r\z", ""))


def _header(firsts: DataFrame, path: str) -> list[str]:
    """The names that the first record of every file gives; one row per different spelling reaches the driver."""
    lines = firsts.select("text").distinct().limit(100).collect()
    found = sorted({tuple(next(csv.reader([r.text.removeprefix("\ufeff")], strict=True))) for r in lines})
    if not found:
        raise ValueError(f"no columns: {path} is empty")
    if len(found) > 1:
        raise ValueError(f"the files below {path} have different headers: {list(found[0])} and {list(found[1])}")
    return list(found[0])


def _unique(names: list[str]) -> list[str]:
    """Names as pandas gives them: absent ones by their place, repeated ones with a number behind."""
    out: list[str] = []
    names = [n or f"Unnamed: {i}" for i, n in enumerate(names)]
    for name in names:
        made, n = name, 0
        while made in out or (n and made in names):
            n += 1
            made = f"{name}.{n}"
        out.append(made)
    return out


def read_csv(
    spark: SparkSession, path: str, types: Mapping[str, str] | None = None, position: str | None = None, quote: str = '"'
) -> DataFrame:
    """The rows of one file or a folder of files with one header, fields separated by commas.

    Quotes inside a quoted field are doubled; its line breaks belong to the
    value. Missing spellings are NULL. ``types`` gives types by column; without
    it they are inferred from all values (see ``inferred``), at the price of one
    more pass. Absent fields at the end of a row are NULL; too many are an
    error, as is a file with another header. ``position`` names a column to add:
    the number of a row, from 0, by file name and place in the file.

    One pass tells whether any quoted field goes over a line end. If none does,
    lines are rows, in whichever blocks a file is read; else records are put
    together first (see ``records``).
    """
    lines = spark.read.text(path, lineSep="\n")
    if lines.filter(_odd("value", quote)).isEmpty():
        # The first lines of the first blocks hold every header.
        heads = (
            lines.select(
                F.col("value").alias("text"), F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_own"),
            )
            .filter(r"text rlike '[^ \t\r]'")
            .groupBy("_file").agg(F.min_by("text", F.struct("_block", "_own")).alias("text"))
        )
        names = _unique(_header(heads.select(F.regexp_replace("text", r"\r\z", "").alias("text")), path))
        texts = _plain_rows(spark, path, names, quote, position)
        # Types do not depend on places, so they are not numbered for that.
        unplaced = _plain_rows(spark, path, names, quote, None)
    else:
        names, texts = _assembled_rows(spark, path, quote, position)
        unplaced = texts.drop(position) if position else texts
    kinds = dict(types) if types is not None else inferred(unplaced)
    return texts.select(
        *[read_as(F.col(f"`{n}`"), kinds[n]).alias(n) for n in names], *([position] if position else [])
    )


def _values(names: list[str], extra: Column, where: Column) -> list[Column]:
    """The fields ``c0, c1, ...`` under their names, missing ones NULL; a field more than there are names is an error."""
    error = F.raise_error(F.concat(F.lit("too many fields in "), where)).cast("string")
    first = F.when(extra.isNotNull(), error).otherwise(F.col("c0"))
    return [missing_to_null(first if i == 0 else F.col(f"c{i}")).alias(n) for i, n in enumerate(names)]


def _plain_rows(spark: SparkSession, path: str, names: list[str], quote: str, position: str | None) -> DataFrame:
    """Rows where no field has a line break: Spark's own reader cuts them."""
    ddl = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"quote": quote, "escape": quote, "nullValue": "", "emptyValue": ""}
    # All columns are parsed, lest a row's fields go uncounted.
    read = spark.read.option("columnPruning", False).csv(
        path, schema=f"{ddl}, bad string", header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="bad", **options
    )
    # A row with too few or too many fields is looked at again, with room for one field more.
    rows = read.withColumn("extra", F.from_csv("bad", f"{ddl}, extra string", options)["extra"])
    # A line of nothing but blanks is no row.
    filled = F.coalesce("c0", F.lit("")).rlike(r"[^ \t]")
    rows = rows.filter(filled | F.col("bad").isNull() | ~F.col("bad").rlike(r"^[ \t]*\r?$"))
    if position:
        rows = numbered_by_place(rows, "_place")
    where = F.coalesce(F.col("bad"), F.lit(path))
    texts = rows.select(*(["_place"] if position else []), *_values(names, F.col("extra"), where))
    return texts.withColumnRenamed("_place", position) if position else texts


def _assembled_rows(
    spark: SparkSession, path: str, quote: str, position: str | None
) -> tuple[list[str], DataFrame]:
    """Names and rows where quoted fields go over line ends."""
    found = records(spark, path, quote)
    # The first record of each file is its header.
    firsts = found.groupBy("_file").agg(F.min("_line").alias("_line"))
    names = _unique(_header(found.join(firsts, ["_file", "_line"]), path))
    ddl = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"quote": quote, "escape": quote, "nullValue": "", "emptyValue": ""}
    # Room for one field more than there are names.
    fields = F.from_csv("text", f"{ddl}, extra string", options).alias("f")
    rows = found.join(firsts, ["_file", "_line"], "left_anti").select("_file", "_line", fields)
    rows = rows.select("_file", "_line", "f.*")
    where = F.concat(F.lit("line "), F.col("_line").cast("string"), F.lit(" of "), F.col("_file"))
    texts = rows.select(*(["_line"] if position else []), *_values(names, F.col("extra"), where))
    return names, _numbered(texts, "_line", position) if position else texts


def _numbered(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Consecutive numbers from 0 in the order of unique whole numbers: counts per chunk of them, then places within."""
    chunk = F.floor(F.col(order) / CHUNK).alias("_chunk")
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(chunk).agg(F.count("*").alias("_rows"))
    starts = starts.select("_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_chunk").orderBy(order)
    placed = rows.select("*", chunk).withColumn("_place", F.row_number().over(within))
    return (
        placed.join(starts, "_chunk")
        .withColumn(name, F.col("_start") + F.col("_place") - 1)
        .drop("_chunk", "_place", "_start", order)
    )


def inferred(texts: DataFrame) -> dict[str, str]:
    """The narrowest type that holds every value of each text column, from one aggregate of all of them.

    Types form a lattice: whole numbers within numbers, both and truth values
    within text. Whole numbers with missing values, and columns without values,
    are doubles; truth values with missing ones are text; whole numbers beyond a
    long are ``decimal(20,0)`` if none is negative or missing, else text. Each
    part is a count or a conjunction, so it combines in any order.
    """
    parts = []
    for i, name in enumerate(texts.columns):
        value = "`" + name.replace("`", "``") + "`"
        is_whole = f"rlike({value}, r'{WHOLE}')"
        number = f"try_cast(trim({value}) as decimal(38,0))"
        # Each condition over the values that are there; none of them at all is false.
        for alias, over, condition in (
            ("whole", value, is_whole),
            ("long", is_whole, f"{number} between {-(2**63)}BD and {2**63 - 1}BD"),
            ("unsigned", is_whole, f"{number} between 0 and {MOST_UNSIGNED}BD"),
            ("number", value, f"rlike({value}, r'{NUMBER}')"),
            ("truth", value, f"{value} in {TRUTH}"),
        ):
            there = f"{value} is not null" if over == value else over
            parts.append(F.expr(f"coalesce(bool_and(case when {there} then coalesce({condition}, false) end), false) {alias}{i}"))
        parts.append(F.expr(f"count({value}) n{i}"))
    row = texts.agg(F.count("*").alias("rows"), *parts).first()
    out = {}
    for i, name in enumerate(texts.columns):
        filled, missing = row[f"n{i}"], row["rows"] - row[f"n{i}"]
        if not filled:
            out[name] = "double" if row["rows"] else "string"
        elif row[f"whole{i}"]:
            if row[f"long{i}"]:
                out[name] = "double" if missing else "bigint"
            else:
                out[name] = "decimal(20,0)" if row[f"unsigned{i}"] and not missing else "string"
        elif row[f"number{i}"]:
            out[name] = "double"
        else:
            out[name] = "boolean" if row[f"truth{i}"] and not missing else "string"
    return out


def read_as(text: Column, kind: str) -> Column:
    """A text column as another type; numbers may have white space around them."""
    return text if kind == "string" else F.trim(text).cast(kind)
