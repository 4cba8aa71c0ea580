"""Column helpers against pandas and Python's string methods."""

from __future__ import annotations

import datetime
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyroom.functions.dates import month_start, plus_days
from tallyroom.functions.numbers import parse_number, rounded, rounded_even
from tallyroom.functions.text import case_style, snake_case_columns, title_case
from tallyroom.plans.game_sales import critic_category, user_category
from tallyroom.plans.realty import exposition_segment

NUMBERS = [
    "1,5", "tbd", "nan", "NaN", "1d", "1f", "1L", "inf", "-inf", "Infinity", "+INF", " 3 ",
    "\t4\n", "1e3", "", ".5", "1.", "1_000", "0x10", "+2", "1,2,3", "1e", "1 2", "-.5e-2",
    "1e400", "True", ".", "-", None,
]
WORDS = [
    "role-playing", "NS", "o'neil", "ACTION rpg", "élan vital", "гонки-симулятор", "3d shooter",
    "", "123", "a1b", "Year of Release", "NA sales", "Critic Score", "GENRE", "genre", None,
]


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_parse_number_like_pandas(spark):
    ours = column(spark, NUMBERS, "string", parse_number)
    texts = pd.Series(NUMBERS, dtype=object).astype("str").str.replace(",", ".")
    theirs = [None if math.isnan(v) else v for v in pd.to_numeric(texts, errors="coerce")]
    assert ours == theirs


def test_title_case_like_python(spark):
    assert column(spark, WORDS, "string", title_case) == [w and w.title() for w in WORDS]


def test_case_style_like_python(spark):
    def style(word):
        if word.islower():
            return "все буквы строчные"
        if word.isupper():
            return "все буквы заглавные"
        return "слово начинается с заглавной буквы" if word.istitle() else "смешанный стиль"

    words = [w for w in WORDS if w is not None]
    assert column(spark, words, "string", case_style) == [style(w) for w in words]


def test_snake_case(spark):
    df = spark.createDataFrame([(1, 2)], "`Year of Release` int, `NA sales` int")
    assert snake_case_columns(df).columns == ["year_of_release", "na_sales"]


@pytest.mark.parametrize(("value", "scale", "wanted"), [
    (2.675, 2, 2.68), (1234.565, 2, 1234.57), (-2.5, 0, -3.0), (0.1 + 0.2, 1, 0.3), (None, 2, None),
])
def test_rounded_half_up(spark, value, scale, wanted):
    assert column(spark, [value], "double", lambda x: rounded(x, scale)) == [wanted]


def test_rounded_even_like_pandas(spark):
    values = [12.125, 12.375, 0.5, 1.005, -3.125, 100.0]
    ours = column(spark, values, "double", lambda x: rounded_even(x, 2))
    assert ours == pd.Series(values).round(2).tolist()


def test_segments(spark):
    days = [None, 0, 1, 30, 31, 90, 91, 180, 181, 900]
    assert column(spark, days, "int", exposition_segment) == [
        None, None, "month", "month", "quarter", "quarter", "half year", "half year",
        "more than half year", "more than half year",
    ]


def test_grades(spark):
    high, middle, low = "высокая оценка", "средняя оценка", "низкая оценка"
    scores = [None, -1.0, 0.0, 2.9, 3.0, 7.9, 8.0, 10.0, 10.1]
    assert column(spark, scores, "double", user_category) == [
        None, None, low, low, middle, middle, high, high, None,
    ]
    scores = [None, -1.0, 0.0, 29.0, 30.0, 79.0, 80.0, 100.0, 101.0]
    assert column(spark, scores, "double", critic_category) == [
        None, None, low, low, middle, middle, high, high, None,
    ]


def test_dates(spark):
    day = datetime.date(2020, 2, 29)
    assert column(spark, [day, None], "date", month_start) == [datetime.date(2020, 2, 1), None]
    assert column(spark, [day], "date", lambda d: plus_days(d, F.lit(1))) == [
        datetime.date(2020, 3, 1)
    ]


def test_rounding_keeps_what_has_no_digits(spark):
    from tallyroom.functions.numbers import rounded, rounded_even

    values = [float("inf"), -float("inf"), float("nan"), 1e29, -1e300, 2.345, None, 0.125]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = df.select(rounded(df.x, 2).alias("up"), rounded_even(df.x, 2).alias("even")).collect()
    assert [str(r.up) for r in row] == ["inf", "-inf", "nan", "1e+29", "-1e+300", "2.35", "None", "0.13"]
    assert [str(r.even) for r in row] == ["inf", "-inf", "nan", "1e+29", "-1e+300", "2.34", "None", "0.12"]
