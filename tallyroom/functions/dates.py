"""Calendar helpers on dates (no session time zone involved)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(value: Column) -> Column:
    return F.trunc(value.cast("date"), "month")


def plus_days(day: Column, days: Column) -> Column:
    return F.date_add(day.cast("date"), days.cast("int"))
