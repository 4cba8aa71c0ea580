"""One key holding a third of all rows: results stay whole, its tasks are split."""

from __future__ import annotations

import datetime

import pytest
from frames import in_spark, random_tables
from pyspark.sql import functions as F

from tallyroom.operators.impute import fill_group_mean
from tallyroom.operators.repeat import repeat_rows
from tallyroom.plans import game, telecom

ROWS = 240_000

SMALL_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


@pytest.fixture
def small_splits(spark):
    for key, value in SMALL_SPLITS.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL_SPLITS:
        spark.conf.unset(key)


def hot(column, size: int):
    """Key 0 for a third of the rows, the others spread over ``size`` keys."""
    return F.when(column % 3 == 0, 0).otherwise(F.pmod(F.xxhash64(column), F.lit(size)))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(ROWS, numPartitions=8).select("id", hot(F.col("id"), 5000).alias("k"))


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.rindex("Initial Plan")]


def test_incomplete_rows_of_a_hot_group_are_split(spark, small_splits, rows):
    df = rows.select(
        "id", F.col("k").alias("platform"), F.lit(2000).alias("year"),
        F.when((F.col("id") % 6 != 0) & (F.col("id") % 7 != 0), 1.5).alias("sales"),
    )
    filled = fill_group_mean(df, ["platform", "year"], ["sales"])
    assert "skew=true" in final_plan(filled)
    assert filled.count() == ROWS
    assert filled.filter("platform = 0 and sales != 1.5").count() == 0


def test_best_selling_item(spark, small_splits, rows):
    """The pairs of the hot item and its buyers are split over tasks in the join."""
    events = rows.select(
        F.col("id").alias("transaction_id"), F.col("id").cast("long").alias("id"),
        F.col("k").alias("item_code"), F.lit(2.0).alias("amount"),
    )
    items = spark.range(5000).select(
        F.col("id").alias("item_code"), F.concat(F.lit("item "), "id").alias("game_items")
    )
    report = game.item_popularity(events, items)
    assert "skew=true" in final_plan(report)
    first = report.first()
    hot_rows = events.filter("item_code = 0").count()
    assert (first.game_items, first.absolute_count) == ("item 0", hot_rows)
    assert first.users_item_share == pytest.approx(hot_rows / ROWS)


def test_repeated_rows(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([1, 2, 6, 7, 50])], "i int, t int")
    for chunk in (1, 3, 7, 1000):
        counts = repeat_rows(df, F.col("t"), chunk).groupBy("i", "t").count().collect()
        assert sorted((r.t, r["count"]) for r in counts) == [(t, t) for t in (1, 2, 6, 7, 50)]


def test_counts_below_one_and_null_count_as_one(spark):
    df = spark.createDataFrame([(0, 0), (1, -1), (2, None), (3, 2)], "i int, t int")
    counts = {r.i: r["count"] for r in repeat_rows(df, F.col("t")).groupBy("i").count().collect()}
    assert counts == {0: 1, 1: 1, 2: 1, 3: 2}


def test_only_rows_with_many_copies_are_shuffled(spark, small_splits):
    """Rows needed up to ``chunk`` times stay where they are, and what lies below is run once."""
    df = spark.range(10_000).select((F.col("id") % 5000).alias("i"))
    df = df.withColumn("t", F.col("i") % 7)
    df = df.groupBy("i").agg(F.max("t").alias("t")).unionByName(
        spark.createDataFrame([(-1, 2500), (-2, 1001)], "i long, t long")
    )
    got = repeat_rows(df, F.col("t"))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Initial Plan")]
    assert "ReusedExchange" in plan
    counts = {r.i: r["count"] for r in got.groupBy("i").count().collect()}
    assert counts == {**{i: max(1, i % 7) for i in range(5000)}, -1: 2500, -2: 1001}


def test_copies_of_one_row_spread_over_the_tasks(spark):
    df = spark.createDataFrame([(0, 100_000), *[(i, 10) for i in range(1, 200)]], "i int, t int")
    tasks = repeat_rows(df, F.col("t")).groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in tasks)
    assert len(sizes) >= 6 and sizes[-1] <= 2.5 * sum(sizes) / len(sizes)


def test_user_with_a_third_of_the_user_rows(spark, rows):
    """Every row of the user gives each of its months, as a join would."""
    users = rows.select(
        F.col("k").alias("user_id"), F.lit("smart").alias("tariff"),
        F.lit(None).cast("date").alias("churn_date"),
    )
    stats = spark.createDataFrame(
        [(u, datetime.date(2020, m, 1), 30, 5.0, 1) for u in (0, 1, -1) for m in (1, 2)],
        "user_id long, dt_month date, month_duration long, month_mb_traffic double, month_sms long",
    )
    tariffs = in_spark(spark, {"tel_tariffs": random_tables(1)["tel_tariffs"]}).tel_tariffs
    got = telecom.overage(stats, users, tariffs)
    joined = stats.join(users.select("user_id", "tariff"), "user_id", "left")
    assert got.count() == joined.count()
    key = ["user_id", "dt_month", "tariff"]
    assert got.groupBy(*key).count().exceptAll(joined.groupBy(*key).count()).isEmpty()


def test_busiest_user_is_combined_before_the_shuffle(spark, rows):
    calls = rows.select(
        F.col("k").alias("user_id"),
        F.expr("date_add(date'2020-01-01', int(id % 300))").alias("call_date"),
        F.lit(1.0).alias("duration"),
    )
    none = spark.createDataFrame([], "user_id long, session_date date, mb_used double")
    texts = spark.createDataFrame([], "user_id long, message_date date")
    stats = telecom.user_month_stats(calls, none, texts)
    busiest = stats.filter("user_id = 0").agg(F.sum("month_duration")).first()[0]
    assert busiest == calls.filter("user_id = 0").count()
    assert stats.filter("user_id = 0").count() == 10
