"""Range labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(bounds: Sequence[tuple[Column, str]]) -> Column:
    """Label of the first condition met; NULL where none is."""
    (condition, name), *rest = bounds
    label = F.when(condition, name)
    for condition, name in rest:
        label = label.when(condition, name)
    return label


def half_open(value: Column, low: float, high: float) -> Column:
    return (value >= low) & (value < high)
