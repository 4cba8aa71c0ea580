"""Cleaning and categorising a sales file of video games.

``row_id`` is the position of a row in the file; it is never compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions.bands import band, half_open
from tallyroom.functions.numbers import parse_number, rounded_even
from tallyroom.functions.text import title_case
from tallyroom.operators.duplicates import flag_later, keep_first
from tallyroom.operators.impute import fill_group_mean
from tallyroom.operators.profile import cardinality, distinct_values, most_frequent

POSITION = "row_id"
NUMERIC_TEXT = ("eu_sales", "jp_sales", "user_score")

# The sentinel, the label of a missing text, the period, the three
# grades, and where the middle and the high grade begin and the scale ends.
NO_SCORE = -1.0
NOT_STATED = "NS"
FIRST_YEAR, LAST_YEAR = 2000, 2013
HIGH, MIDDLE, LOW = "высокая оценка", "средняя оценка", "низкая оценка"
USER_SCALE = (3, 8, 10)
CRITIC_SCALE = (30, 80, 100)


def fix_year(games: DataFrame) -> DataFrame:
    """Rows with a year, as a whole number. Unlike ``dropna``, the NULL test is pushed down."""
    year = F.col("year_of_release")
    return games.filter(year.isNotNull() & ~F.isnan(year)).withColumn(
        "year_of_release", year.cast("int")
    )


def fix_numbers(games: DataFrame) -> DataFrame:
    return games.withColumns({c: parse_number(F.col(c)) for c in NUMERIC_TEXT})


def fill_scores(games: DataFrame) -> DataFrame:
    return games.fillna(NO_SCORE, subset=["user_score", "critic_score"])


def impute_sales(games: DataFrame) -> DataFrame:
    """Regional sales filled with the mean of the platform and year."""
    return fill_group_mean(games, ["platform", "year_of_release"], ["eu_sales", "jp_sales"])


def fill_labels(games: DataFrame) -> DataFrame:
    return games.fillna(NOT_STATED, subset=["name", "genre", "rating"])


def typed(games: DataFrame) -> DataFrame:
    return fix_numbers(fix_year(games))


def filled(games: DataFrame) -> DataFrame:
    """All repairs of single values: one map over the file."""
    return fill_labels(fill_scores(typed(games)))


def distinct_counts(games: DataFrame) -> DataFrame:
    return cardinality(filled(games), {"name": "lower", "genre": "lower", "rating": "upper"})


def sorted_values(games: DataFrame) -> DataFrame:
    return distinct_values(filled(games), ["platform", "year_of_release", "genre", "rating"])


def duplicate_flags(games: DataFrame) -> DataFrame:
    rows = filled(games)
    return flag_later(
        rows,
        {
            "is_duplicate": [c for c in rows.columns if c != POSITION],
            "is_key_duplicate": ["name", "platform", "year_of_release"],
        },
        POSITION,
    )


def deduplicated(games: DataFrame) -> DataFrame:
    """Before the case is folded, so spellings that differ in case survive."""
    return keep_first(filled(games), POSITION)


def fold_case(games: DataFrame) -> DataFrame:
    return games.withColumns({"genre": title_case(F.col("genre")), "rating": F.upper("rating")})


def cleaned(games: DataFrame) -> DataFrame:
    return fold_case(deduplicated(games))


def folded_counts(games: DataFrame) -> DataFrame:
    """Distinct genres and ratings after folding, beside the count before it."""
    before_after = cardinality(
        fold_case(filled(games)), {"genre": "lower", "rating": "upper"}
    )
    return before_after.select("column_name", F.col("distinct_raw").alias("distinct_values"))


def removed_rows(games: DataFrame) -> DataFrame:
    """Rows lost to a missing year or as duplicates; the share is of the rows left.

    One pass: rows without a year stay in as groups of their own kind, so the
    file's length and the rows left come from the same shuffle.
    """
    year = F.col("year_of_release")
    rows = fill_labels(fill_scores(fix_numbers(games))).withColumn(
        "year_of_release", F.when(~F.isnan(year), year.cast("int"))
    )
    groups = rows.groupBy(*[c for c in rows.columns if c != POSITION]).agg(
        F.count("*").alias("n")
    )
    removed = F.col("loaded") - F.col("left")
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("loaded"), F.count("year_of_release").alias("left")
    ).select(
        removed.alias("removed"),
        rounded_even(removed * 100.0 / F.col("left"), 2).alias("removed_pct"),
    )


def in_period(games: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    return games.filter(F.col("year_of_release").between(first, last))


def _grade(score: Column, scale: tuple[int, int, int]) -> Column:
    """No grade for anything outside the scale, the sentinel included."""
    middle, high, top = scale
    return band(
        [
            (score.between(high, top), HIGH),
            (half_open(score, middle, high), MIDDLE),
            (half_open(score, 0, middle), LOW),
        ]
    )


def user_category(score: Column) -> Column:
    return _grade(score, USER_SCALE)


def critic_category(score: Column) -> Column:
    return _grade(score, CRITIC_SCALE)


def period_games(games: DataFrame) -> DataFrame:
    """The whole chain: cleaned games of the period with both grades.

    Catalyst moves the year filter below the duplicate drop, whose key holds
    the year, so other years are never shuffled.
    """
    return in_period(cleaned(games)).withColumns(
        {
            "user_category": user_category(F.col("user_score")),
            "critic_category": critic_category(F.col("critic_score")),
        }
    )


def top_platforms(games: DataFrame, k: int = 7) -> DataFrame:
    return most_frequent(in_period(cleaned(games)), "platform", k)
