"""Monthly usage of telecom services, overage against the tariff, and cost.

Tables: users (one row per user and tariff held), calls, internet, messages,
and tariffs, whose key is ``tariff_name``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.dates import month_start
from tallyroom.functions.numbers import ratio, rounded
from tallyroom.operators.profile import any_null
from tallyroom.operators.repeat import repeat_rows
from tallyroom.sources.relations import bucketed_relation

USER_COLUMNS = (
    "user_id", "age", "churn_date", "city", "first_name", "last_name", "reg_date", "tariff",
)
USER_MONTH = ("user_id", "dt_month")


# Checks of the tables

def users_any_null(users: DataFrame) -> DataFrame:
    """Users lacking any field. An active user has no churn date, so matches."""
    return users.filter(any_null(USER_COLUMNS))


def active_share(users: DataFrame) -> DataFrame:
    active = F.count_if(F.col("churn_date").isNull())
    return users.agg(ratio(active, F.count("*")).alias("share"))


def multi_tariff_users(users: DataFrame) -> DataFrame:
    return (
        users.filter(F.col("churn_date").isNull())
        .groupBy("user_id")
        .agg(F.count_distinct("tariff").alias("tariff_count"))
        .filter(F.col("tariff_count") > 1)
    )


def calls_null_rows(calls: DataFrame) -> DataFrame:
    return calls.filter(any_null(["duration", "call_date"]))


def call_duration_range(calls: DataFrame) -> DataFrame:
    return calls.agg(
        F.min("duration").alias("min_duration"), F.max("duration").alias("max_duration")
    )


def missed_call_share(calls: DataFrame) -> DataFrame:
    missed = F.count_if(F.col("duration") == 0)
    return calls.agg(ratio(missed, F.count("*")).alias("share"))


def top_daily_talk(calls: DataFrame, k: int = 10) -> DataFrame:
    """User-days by hours talked. A day without any duration sorts first."""
    return (
        calls.groupBy("user_id", "call_date")
        .agg((F.sum("duration") / 60.0).alias("total_day_duration"))
        .orderBy(
            F.col("total_day_duration").desc_nulls_first(),
            F.col("user_id").asc_nulls_last(),
            F.col("call_date").asc_nulls_last(),
        )
        .limit(k)
    )


# Usage per user and month

def _by_month(df: DataFrame, date: str, **measures: Column) -> DataFrame:
    return df.select(
        "user_id",
        month_start(F.col(date)).alias("dt_month"),
        *[value.alias(name) for name, value in measures.items()],
    )


def _month_total(measure: str) -> Column:
    """How each measure is summed; minutes are rounded up after summing."""
    total = F.sum(measure)
    return (F.ceil(total) if measure == "month_duration" else total).alias(measure)


def monthly_minutes(calls: DataFrame) -> DataFrame:
    rows = _by_month(calls, "call_date", month_duration=F.col("duration"))
    return rows.groupBy(*USER_MONTH).agg(_month_total("month_duration"))


def monthly_traffic(internet: DataFrame) -> DataFrame:
    rows = _by_month(internet, "session_date", month_mb_traffic=F.col("mb_used"))
    return rows.groupBy(*USER_MONTH).agg(_month_total("month_mb_traffic"))


def monthly_sms(messages: DataFrame) -> DataFrame:
    rows = _by_month(messages, "message_date")
    return rows.groupBy(*USER_MONTH).agg(F.count("*").alias("month_sms"))


def activity_months(calls: DataFrame, internet: DataFrame, messages: DataFrame) -> DataFrame:
    """Distinct user-months over the three services."""
    return (
        _by_month(calls, "call_date")
        .union(_by_month(internet, "session_date"))
        .union(_by_month(messages, "message_date"))
        .distinct()
    )


def user_month_stats(calls: DataFrame, internet: DataFrame, messages: DataFrame) -> DataFrame:
    """All active user-months with the three totals; an unused service is NULL.

    The services are stacked and summed once, instead of three aggregates, a
    distinct union and three joins: one shuffle of already combined rows. A
    sum over NULLs alone is NULL, like a join without a partner. A NULL user or
    month equals nothing in a join, so such rows carry no totals.
    """
    calls = _by_month(calls, "call_date", month_duration=F.col("duration").cast("double"))
    internet = _by_month(
        internet, "session_date", month_mb_traffic=F.col("mb_used").cast("double")
    )
    messages = _by_month(messages, "message_date", month_sms=F.lit(1))
    stacked = calls.unionByName(internet, allowMissingColumns=True).unionByName(
        messages, allowMissingColumns=True
    )
    measures = ["month_duration", "month_mb_traffic", "month_sms"]
    known = F.col("user_id").isNotNull() & F.col("dt_month").isNotNull()
    return (
        stacked.groupBy(*USER_MONTH)
        .agg(*[_month_total(m) for m in measures])
        .select(*USER_MONTH, *[F.when(known, F.col(m)).alias(m) for m in measures])
    )


# Overage and cost

def _above(used: str, included: str) -> Column:
    excess = F.col(used) - F.col(included)
    return F.when(excess > 0, excess).otherwise(0)


def with_overage(user_months: DataFrame, tariffs: DataFrame) -> DataFrame:
    """User-months with a ``tariff`` column: usage beyond what the tariff includes.

    The tariff columns stay for pricing. Catalyst broadcasts the tariffs when
    their size allows it.
    """
    return (
        user_months.join(tariffs, F.col("tariff") == F.col("tariff_name"), "left")
        .withColumns(
            {
                "duration_over": _above("month_duration", "minutes_included"),
                "gb_traffic_over": _above("month_mb_traffic", "mb_per_month_included").cast(
                    "double"
                )
                / 1024,
                "sms_over": _above("month_sms", "messages_included"),
            }
        )
    )


def with_cost(overage: DataFrame) -> DataFrame:
    return overage.withColumn(
        "total_cost",
        F.col("rub_monthly_fee")
        + F.col("duration_over") * F.col("rub_per_minute")
        + F.col("gb_traffic_over") * F.col("rub_per_gb")
        + F.col("sms_over") * F.col("rub_per_message"),
    )


def tariffs_held(users: DataFrame) -> DataFrame:
    """How many rows, and active rows, each user has per tariff."""
    return users.groupBy("user_id", "tariff").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("churn_date").isNull()).alias("active"),
    )


@contextmanager
def bucketed_by_user(
    stats: DataFrame, users: DataFrame, buckets: int
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """User-months and tariffs held, stored by user: T14 to T17 then join without a shuffle.

    Both are combined already, at most one row per user and month or tariff,
    so no bucket fills up with the rows of one busy user. The reports take the
    second table in place of the users.
    """
    with (
        bucketed_relation(stats, "user_months", ["user_id"], buckets) as months,
        bucketed_relation(tariffs_held(users), "tariffs_held", ["user_id"], buckets) as held,
    ):
        yield months, held


def _held(users: DataFrame) -> DataFrame:
    """Tariffs held: counted from the users, unless the counts are given."""
    return users if {"rows", "active"} <= set(users.columns) else tariffs_held(users)


def _with_tariffs_held(stats: DataFrame, users: DataFrame) -> DataFrame:
    """User-months by every row of the user; unknown users keep their months.

    Equal rows of a user are counted before the join and repeated after it, so
    the join never gathers a user's many rows.
    """
    joined = stats.join(_held(users), "user_id", "left")
    repeated = repeat_rows(joined, F.coalesce("rows", F.lit(1)))
    return repeated.select(*stats.columns, "tariff")


def overage(stats: DataFrame, users: DataFrame, tariffs: DataFrame) -> DataFrame:
    """One row per user-month and tariff held."""
    return with_overage(_with_tariffs_held(stats, users), tariffs).select(
        "user_id", "dt_month", "tariff", "month_duration", "month_mb_traffic", "month_sms",
        "duration_over", "gb_traffic_over", "sms_over",
    )


def month_cost(stats: DataFrame, users: DataFrame, tariffs: DataFrame) -> DataFrame:
    return with_cost(with_overage(_with_tariffs_held(stats, users), tariffs)).select(
        "user_id", "dt_month", "tariff", "month_duration", "month_mb_traffic", "month_sms",
        "rub_monthly_fee", "total_cost",
    )


def _weighted_costs(stats: DataFrame, users: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Costs of active users; ``weight`` is how many joined rows a row stands for.

    Costs meet the users table twice: by every row of the user for the tariff,
    then by every active row for the filter. Counting those rows first gives
    the same averages without multiplying a user's months by its rows squared.
    A user missing from the table counts as active, with no tariff.
    """
    # At most one row per tariff and user reaches this window.
    of_user = Window.partitionBy("user_id")
    weights = _held(users).select(
        "user_id",
        "tariff",
        (F.col("rows") * F.sum("active").over(of_user)).alias("weight"),
    )
    weighted = (
        stats.join(weights, "user_id", "left")
        .withColumn("weight", F.coalesce("weight", F.lit(1)))
        .filter(F.col("weight") > 0)
    )
    return with_cost(with_overage(weighted, tariffs))


def _weighted_mean(value: Column) -> Column:
    counted = F.when(value.isNotNull(), F.col("weight"))
    return F.sum(value * F.col("weight")) / F.sum(counted)


def avg_cost_by_tariff(stats: DataFrame, users: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Active users and their mean monthly cost per tariff."""
    return (
        _weighted_costs(stats, users, tariffs)
        .groupBy("tariff")
        .agg(
            F.count_distinct("user_id").alias("total_users"),
            rounded(_weighted_mean(F.col("total_cost")), 2).alias("avg_total_cost"),
        )
    )


def overcost_by_tariff(stats: DataFrame, users: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Months that cost more than the fee: users, mean cost, mean amount above."""
    cost, fee = F.col("total_cost"), F.col("rub_monthly_fee")
    return (
        _weighted_costs(stats, users, tariffs)
        .filter(cost > fee)
        .groupBy("tariff", "rub_monthly_fee")
        .agg(
            F.count_distinct("user_id").alias("total_users"),
            rounded(_weighted_mean(cost), 2).alias("avg_total_cost"),
            rounded(_weighted_mean(cost - fee), 2).alias("overcost"),
        )
        .drop("rub_monthly_fee")
    )
