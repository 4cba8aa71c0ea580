"""Number parsing, shares and rounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings pandas.to_numeric accepts as a number.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"

# From here on a double has no digits that a decimal with ten could hold.
ROUNDED_BELOW = 1e27


def rounded(value: Column, scale: int) -> Column:
    """Round half up on the decimal digits, as a double.

    Going through ten decimals first drops the noise that the order of a
    distributed double sum leaves in the last bits. A bare ``decimal`` cast
    would have no fraction digits at all, so the scale is always given.
    Infinity, NaN and numbers too large to have such digits stay as they are.
    """
    return _where_exact(value, lambda v: F.round(v, scale))


def rounded_even(value: Column, scale: int) -> Column:
    """Round half to even, as pandas does; what cannot be rounded stays as it is."""
    return _where_exact(value, lambda v: F.bround(v, scale))


def _where_exact(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` on the ten-digit decimal of values under 1e27, as a double; others unchanged."""
    number = value.cast("double")
    small = F.abs(number) < ROUNDED_BELOW
    return F.when(small, use(F.when(small, value).cast("decimal(38,10)")).cast("double")).otherwise(number)


def ratio(part: Column, whole: Column) -> Column:
    """Real division of two counts; an empty whole raises, as ANSI SQL does."""
    return part.cast("double") / whole.cast("double")


def parse_number(text: Column) -> Column:
    """Text to double with either decimal separator; anything else is NULL.

    The pattern guards the cast: Spark alone would read ``1d`` as 1.0.
    """
    dotted = F.translate(text, ",", ".")
    sign = F.when(F.trim(dotted).startswith("-"), -1.0).otherwise(1.0)
    finite = F.when(dotted.rlike(NUMBER_PATTERN), F.trim(dotted).try_cast("double"))
    return F.when(
        dotted.rlike(INFINITY_PATTERN), sign * F.lit(float("inf"))
    ).otherwise(F.when(F.abs(finite) != float("inf"), finite))
