"""Missing values filled from group means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.profile import any_null


def fill_group_mean(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill NULLs with the mean of the rows with equal keys.

    A NULL key equals nothing, and a group without any value has no mean: both
    stay NULL. Only the incomplete rows are joined; complete ones never move.
    """
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])
    lacking = any_null(columns)
    filled = (
        df.filter(lacking)
        .join(means, list(keys), "left")
        .withColumns({c: F.coalesce(F.col(c), F.col(f"mean_{c}")) for c in columns})
    )
    return df.filter(~lacking).unionByName(filled.select(*df.columns))
