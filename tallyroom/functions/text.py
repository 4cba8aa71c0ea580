"""Letter case and column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The four verdicts on a name's letter case.
STYLE_LOWER = "все буквы строчные"
STYLE_UPPER = "все буквы заглавные"
STYLE_TITLE = "слово начинается с заглавной буквы"
STYLE_MIXED = "смешанный стиль"

# Runs of cased letters and the runs between them.
_LETTER_RUNS = r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"


def title_case(text: Column) -> Column:
    """Capital after every non-letter: ``role-playing`` becomes ``Role-Playing``.

    ``initcap`` starts a word at whitespace only.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(_LETTER_RUNS), F.lit(0))
    capital = F.transform(
        runs, lambda run: F.concat(F.upper(run.substr(1, 1)), F.substring(run, 2, 2**31 - 1))
    )
    return F.array_join(capital, "")


def case_style(text: Column) -> Column:
    """Which of the four letter-case styles a name is written in."""
    has_letters = F.lower(text) != F.upper(text)
    return (
        F.when(has_letters & (text == F.lower(text)), STYLE_LOWER)
        .when(has_letters & (text == F.upper(text)), STYLE_UPPER)
        .when(has_letters & (text == title_case(text)), STYLE_TITLE)
        .otherwise(STYLE_MIXED)
    )


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.replace(" ", "_").lower() for name in df.columns])
