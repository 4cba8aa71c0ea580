"""Duplicate rows: first occurrence kept, later ones flagged.

A DataFrame has no row order, so callers name the column that holds each row's
position in its source. It must be unique.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Position of the first row of every group of equal keys (NULL = NULL).

    A minimum is combined before the shuffle, so a group holding a third of
    the rows costs one row per map task; a window would sort it in one task.
    """
    return df.groupBy(*keys).agg(F.min(position).alias(position))


def keep_first(df: DataFrame, position: str) -> DataFrame:
    """Drop full duplicates, all columns but the position compared."""
    keys = [c for c in df.columns if c != position]
    return first_rows(df, keys, position).select(*df.columns)


def flag_later(
    df: DataFrame, flags: dict[str, Sequence[str]], position: str
) -> DataFrame:
    """A boolean per entry of ``flags``: whether an earlier row has equal keys.

    The firsts of all keys together hold those of every part of them, so the
    table is combined once. All flags come back in one join by position, which
    is unique, so it spreads evenly however large a group of equal rows is.
    """
    wide = [c for c in df.columns if any(c in keys for keys in flags.values())]
    rows = first_rows(df, wide, position)
    marks = [
        (rows if set(keys) == set(wide) else first_rows(rows, keys, position)).select(
            position, *[F.lit(flag == other).alias(other) for other in flags]
        )
        for flag, keys in flags.items()
    ]
    firsts = reduce(DataFrame.union, marks).groupBy(position).agg(*[F.bool_or(f).alias(f) for f in flags])
    return df.join(firsts, position, "left").select(
        *df.columns, *[(~F.coalesce(F.col(flag), F.lit(False))).alias(flag) for flag in flags]
    )
