"""The sales file and its cleaning, step by step against pandas."""

from __future__ import annotations

import datetime

import pandas as pd
import pytest
from frames import fields, in_spark, random_tables
from pyspark.sql import functions as F

from tallyroom.operators.duplicates import flag_later, keep_first
from tallyroom.operators.impute import fill_group_mean
from tallyroom.operators.profile import most_frequent
from tallyroom.plans import game_sales
from tallyroom.sources.game_sales import HEADER, NA_TOKENS, read_games_csv

ROWS = [
    ['Halo, "the" game', "XB", "2001", "Shooter", "1.5", "0,5", "tbd", "0", "90", "8.1", "M"],
    *[["x", token, token, token, token, token, token, token, token, token, token]
      for token in NA_TOKENS],
    ["NaN", "PS", "1999.0", "NS", "0.0", "unknown", "1e1", "2", "77", "tbd", "e"],
]


def plain(values):
    return [None if v is None or v != v else v for v in values]


def test_file_loads_like_pandas(spark, tmp_path):
    path = str(tmp_path / "games.csv")
    pd.DataFrame(ROWS, columns=list(HEADER)).to_csv(path, index=False)
    ours = read_games_csv(spark, path)
    theirs = pd.read_csv(path)
    assert ours.columns == list(theirs.columns)
    rows = ours.collect()
    for name in HEADER:
        got = [r[name] for r in rows]
        expected = plain(theirs[name])
        if HEADER[name] == "string":
            expected = [None if v is None else str(v) for v in expected]
        assert got == expected, name


def pandas_frame(rows):
    df = pd.DataFrame(rows, columns=[f for f, _ in fields("raw_games")])
    return df.sort_values("row_id").drop(columns="row_id")


@pytest.fixture(scope="module", params=[11, 12])
def games(request, spark):
    rows = random_tables(request.param)["raw_games"]
    return in_spark(spark, {"raw_games": rows}).raw_games.repartition(3), pandas_frame(rows)


def as_lists(df, *drop):
    return sorted(map(str, (plain(r) for r in df.drop(*drop).collect())))


def pandas_filled(df):
    df = df.dropna(subset=["year_of_release"]).copy()
    for c in ["eu_sales", "jp_sales", "user_score"]:
        df[c] = pd.to_numeric(df[c].astype("str").str.replace(",", "."), errors="coerce")
    for c, value in {
        "user_score": -1.0, "critic_score": -1.0, "name": "NS", "genre": "NS", "rating": "NS",
    }.items():
        df[c] = df[c].fillna(value)
    return df.astype({"year_of_release": int})


def test_whole_chain_like_pandas(games):
    ours, theirs = games
    df = pandas_filled(theirs).drop_duplicates()
    df["genre"], df["rating"] = df["genre"].str.title(), df["rating"].str.upper()
    df = df[df["year_of_release"].between(2000, 2013)]
    ours = game_sales.in_period(game_sales.cleaned(ours))
    assert as_lists(ours, "row_id") == sorted(map(str, (plain(r) for r in df.values.tolist())))


def test_duplicate_flags_like_pandas(games):
    ours, theirs = games
    df = pandas_filled(theirs)
    rows = game_sales.duplicate_flags(ours).orderBy("row_id").collect()
    assert [r.is_duplicate for r in rows] == df.duplicated().tolist()
    key = ["name", "platform", "year_of_release"]
    assert [r.is_key_duplicate for r in rows] == df.duplicated(subset=key).tolist()


def test_removed_rows_like_pandas(games):
    ours, theirs = games
    left = len(pandas_filled(theirs).drop_duplicates())
    row = game_sales.removed_rows(ours).first()
    assert row.removed == len(theirs) - left
    assert row.removed_pct == pytest.approx((len(theirs) - left) / left * 100, abs=0.005)


def test_counts_like_pandas(games):
    ours, theirs = games
    df = pandas_filled(theirs)
    got = {r.column_name: (r.distinct_raw, r.distinct_folded)
           for r in game_sales.distinct_counts(ours).collect()}
    assert got == {
        "name": (df["name"].nunique(), df["name"].str.lower().nunique()),
        "genre": (df["genre"].nunique(), df["genre"].str.lower().nunique()),
        "rating": (df["rating"].nunique(), df["rating"].str.upper().nunique()),
    }


def test_folding_never_adds_values(games):
    raw, _ = games
    before = {r.column_name: r.distinct_raw for r in game_sales.distinct_counts(raw).collect()}
    after = game_sales.folded_counts(raw).collect()
    assert all(r.distinct_values <= before[r.column_name] for r in after)


def test_impute_like_pandas(games):
    ours, theirs = games
    df = pandas_filled(theirs)
    keys, columns = ["platform", "year_of_release"], ["eu_sales", "jp_sales"]
    means = df.groupby(keys, dropna=True)[columns].transform("mean")
    for c in columns:
        df[c] = df[c].fillna(means[c])
    got = game_sales.impute_sales(game_sales.filled(ours)).orderBy("row_id").collect()
    for c in columns:
        assert plain([r[c] for r in got]) == pytest.approx(plain(df[c]), nan_ok=True)


def test_nan_counts_as_missing(spark):
    row = random_tables(1)["raw_games"][0]
    rows = [(1, *row[1:3], float("nan"), *row[4:]), (2, *row[1:3], 2001.0, *row[4:])]
    games = in_spark(spark, {"raw_games": rows}).raw_games
    assert [r.row_id for r in game_sales.cleaned(games).collect()] == [2]
    assert tuple(game_sales.removed_rows(games).first()) == (1, 100.0)


def test_group_without_values_stays_missing(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 1, None), ("b", 1, 2.0), ("b", 1, None), (None, 1, None),
         (None, 1, 5.0)],
        "p string, y int, v double",
    )
    got = fill_group_mean(df, ["p", "y"], ["v"]).orderBy("p", "v").collect()
    assert [r.v for r in got] == [None, 5.0, None, None, 2.0, 2.0]


def test_hot_group_of_copies(spark):
    """A third of the rows are copies of one."""
    df = spark.range(3000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v")
    ).repartition(6)
    assert keep_first(df, "row_id").count() == 2001
    assert keep_first(df, "row_id").filter("v = -1").first().row_id == 0
    flagged = flag_later(df, {"again": ["v"]}, "row_id").filter("again")
    assert flagged.count() == 999
    assert flagged.filter("row_id = 0").count() == 0


def test_frequency_ties_go_by_name(spark):
    names = ["b", "b", "a", "a", "c", None, None, None]
    df = spark.createDataFrame([(n,) for n in names], "platform string")
    assert [tuple(r) for r in most_frequent(df, "platform", 2).collect()] == [("a", 2), ("b", 2)]


def test_year_filter_reaches_below_the_duplicate_drop(spark):
    rows = random_tables(1)["raw_games"]
    games = in_spark(spark, {"raw_games": rows}).raw_games
    plan = game_sales.top_platforms(games)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Aggregate [", 2)[1:] if plan.count("Aggregate [") > 1 else ("", plan)
    assert "2013" in below


def test_day_type_is_untouched_by_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([(datetime.date(2020, 1, 1),)], "d date")
        assert df.select(F.trunc("d", "month")).first()[0] == datetime.date(2020, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def written(folder, name, rows, columns=tuple(HEADER)):
    pd.DataFrame(rows, columns=list(HEADER))[list(columns)].to_csv(folder / name, index=False)


def test_columns_are_found_by_name(spark, tmp_path):
    columns = sorted(HEADER, reverse=True)
    written(tmp_path, "games.csv", ROWS, columns)
    rows = read_games_csv(spark, str(tmp_path / "games.csv")).collect()
    assert rows[0]["Name"] == ROWS[0][0] and rows[0]["Platform"] == "XB"


def test_other_headers_are_refused(spark, tmp_path):
    written(tmp_path, "short.csv", ROWS, [c for c in HEADER if c != "Genre"])
    with pytest.raises(ValueError, match="Genre"):
        read_games_csv(spark, str(tmp_path / "short.csv"))
    both = tmp_path / "both"
    both.mkdir()
    written(both, "a.csv", ROWS)
    written(both, "b.csv", ROWS, sorted(HEADER))
    with pytest.raises(Exception, match="(?i)header"):
        read_games_csv(spark, str(both)).collect()


def test_line_breaks_inside_fields(spark, tmp_path):
    rows = [["two\nlines", *ROWS[0][1:]], ROWS[-1]]
    written(tmp_path, "games.csv", rows)
    path = str(tmp_path / "games.csv")
    whole = read_games_csv(spark, path, multi_line=True).collect()
    assert [r["Name"] for r in whole] == ["two\nlines", None]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_games_csv(spark, path).collect()


def test_rows_are_numbered_by_file_and_place(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    names = [f"game {i}" for i in range(3000)]
    for part in range(3):
        written(folder, f"{part}.csv", [[n, *ROWS[0][1:]] for n in names[part * 1000 : (part + 1) * 1000]])
    for size in ("128m", "20k"):  # whole files, and several splits of each
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = read_games_csv(spark, str(folder), position="row_id").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r["Name"] for r in sorted(rows, key=lambda r: r.row_id)] == names
        assert sorted(r.row_id for r in rows) == list(range(3000))


def test_all_flags_come_back_in_one_join(spark, games):
    ours, _ = games
    flagged = game_sales.duplicate_flags(ours)
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
