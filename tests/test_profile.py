"""Table profiles against pandas and hand-made cases."""

from __future__ import annotations

import datetime
from types import SimpleNamespace

import pandas as pd
import pytest
from frames import in_spark, random_tables

from tallyroom.operators import profile
from tallyroom.session import scratch_path
from tallyroom.sources.game_sales import with_file_header

DAY = datetime.date(2020, 1, 1)


@pytest.fixture(scope="module")
def games(spark):
    rows = random_tables(4)["raw_games"]
    df = in_spark(spark, {"raw_games": rows}).raw_games
    return df, pd.DataFrame(rows, columns=df.columns)


def test_frame_info_like_pandas(games):
    df, pdf = games
    got = {r.column_name: r.non_null for r in profile.frame_info(df).collect()}
    assert got == pdf.notna().sum().to_dict()
    types = {r.column_name: r.data_type for r in profile.frame_info(df).collect()}
    assert types == dict(df.dtypes)


def test_null_profile_like_pandas(games):
    df, pdf = games
    rows = profile.null_profile(df).collect()
    assert {r.column_name: r.missing for r in rows} == pdf.isna().sum().to_dict()
    share = (pdf.isna().sum() / len(pdf) * 100).to_dict()
    assert {r.column_name: r.missing_pct for r in rows} == pytest.approx(share, abs=0.005)


def test_name_styles(games):
    df, _ = games
    named = with_file_header(df)
    styles = {r.column_name: r.style for r in profile.name_styles(named).collect()}
    assert styles["row_id"] == "все буквы строчные"
    assert styles["Critic Score"] == "слово начинается с заглавной буквы"
    assert styles["Year of Release"] == styles["NA sales"] == "смешанный стиль"


def test_frequencies_like_value_counts(games):
    df, pdf = games
    got = {r.genre: r["count"] for r in profile.frequencies(df, "genre").collect()}
    assert got == pdf["genre"].value_counts().to_dict()


def test_distinct_values_are_sorted_with_missing_last(games):
    df, pdf = games
    rows = profile.distinct_values(df, ["genre", "rating"]).collect()
    for column in ["genre", "rating"]:
        got = [r.value for r in rows if r.column_name == column]
        assert got == [*sorted(pdf[column].dropna().unique()), None]


CATALOGUE = [
    # id, day, repeated number, wide repeated number, text key, text with a NULL, real key
    (1, DAY, 1, 10, "a", "x", 0.5),
    (2, DAY + datetime.timedelta(1), 1, 10, "b", None, 1.5),
    (3, DAY + datetime.timedelta(2), 2, 900, "c", "y", 2.5),
]
SCHEMA = "id bigint, day date, few int, wide int, t string, n string, r double"


def test_key_flags(spark):
    df = spark.createDataFrame(CATALOGUE, SCHEMA)
    rows = profile.column_catalogue(df, "some").collect()
    assert {r.column_name: r.is_key for r in rows} == {
        "id": True, "day": True, "few": False, "wide": False, "t": True, "n": False, "r": True,
    }
    assert {r.column_name: r.data_type for r in rows} == dict(df.dtypes)
    assert {r.table_name for r in rows} == {"some"}


def test_no_column_can_be_a_key(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert [r.is_key for r in profile.column_catalogue(df, "t").collect()] == [False, False]


def test_listing_the_columns_runs_no_job_before_it_is_asked_for(spark):
    context = spark.sparkContext
    df = spark.createDataFrame(CATALOGUE, SCHEMA)
    context.setJobGroup("catalogue", "plans only")
    try:
        profile.column_catalogue(df, "some")
        assert len(context.statusTracker().getJobIdsForGroup("catalogue")) == 0
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_every_column_of_an_empty_table_is_a_key(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert all(r.is_key for r in profile.column_catalogue(df, "t").collect())


def test_preview_and_total(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(20)], "a int, b int")
    rows = profile.with_total(profile.preview(df, ["a", "b"], 3), df).collect()
    assert [tuple(r) for r in rows] == [(0, 0, 20), (0, 5, 20), (0, 10, 20)]


def test_tables_of_a_database(spark):
    spark.sql("create database shop")
    try:
        spark.range(3).write.saveAsTable("shop.orders")
        spark.range(2).write.saveAsTable("shop.items")
        spark.range(1).createOrReplaceTempView("not_stored")
        names = [r.table_name for r in profile.list_tables(spark, "shop").collect()]
        assert sorted(names) == ["items", "orders"]
        counts = profile.row_counts({n: spark.table(f"shop.{n}") for n in names})
        assert sorted(map(tuple, counts.collect())) == [("items", 2), ("orders", 3)]
    finally:
        spark.catalog.dropTempView("not_stored")
        spark.sql("drop database shop cascade")


def test_scratch_follows_the_shared_folder():
    # The setting is fixed when a session starts, so a stand-in carries it here.
    conf = SimpleNamespace(get={"spark.checkpoint.dir": "/shared/folder/"}.get)
    first, second = (scratch_path(SimpleNamespace(conf=conf), "x") for _ in range(2))
    assert first.startswith("/shared/folder/x-")
    assert first != second


def test_numbers_are_sorted_as_numbers_and_dotted_names_work(spark):
    df = spark.createDataFrame(
        [(9, "b", 1.5), (100, "a", -2.0), (10, None, None), (None, "a", 10.0)], "`a.b` int, c string, `d.e` double"
    )
    rows = profile.distinct_values(df, ["a.b", "c", "d.e"]).collect()
    values = {c: [r.value for r in rows if r.column_name == c] for c in df.columns}
    assert values == {"a.b": ["9", "10", "100", None], "c": ["a", "b", None], "d.e": ["-2.0", "1.5", "10.0", None]}
    listed = {r.column_name: r.is_key for r in profile.column_catalogue(df, "t").collect()}
    assert listed == {"a.b": False, "c": False, "d.e": False}
    assert profile.cardinality(df, {"c": "upper"}).first().distinct_raw == 2
    assert [r["count"] for r in profile.most_frequent(df, "a.b", 5).collect()] == [1, 1, 1]


def test_tables_are_listed_from_the_folder(spark, tmp_path):
    from tallyroom.registry import queries

    spark.range(3).write.parquet(str(tmp_path / "extra.parquet"))
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "region.parquet"))
    (tmp_path / "notes.txt").write_text("no table")
    rows = queries()["cat_tables"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [("extra", 3), ("region", 5)]
