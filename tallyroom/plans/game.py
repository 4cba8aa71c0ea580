"""Game purchases: payers, amounts, items and a report per race.

Tables: users (``payer`` is 0 or 1), race, items and events (one purchase each;
a purchase of amount zero or NULL does not count as one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions.numbers import ratio
from tallyroom.operators.percentile import exact_percentiles
from tallyroom.operators.profile import preview, with_total

# The columns of users, and those checked for missing values; for
# events also under which name their filled rows are counted.
USER_COLUMNS = (
    "id", "tech_nickname", "class_id", "ch_id", "birthdate", "pers_gender",
    "registration_dt", "server", "race_id", "payer", "loc_id",
)
USER_CHECKED = ("loc_id", "class_id", "ch_id", "pers_gender", "server", "race_id", "payer")
EVENT_CHECKED = {
    "date": "data_count", "time": "data_time", "amount": "data_amount",
    "seller_id": "data_seller_id",
}

def _pays() -> Column:
    return F.col("payer") == 1


def payer_share(users: DataFrame) -> DataFrame:
    return users.agg(
        F.count("*").alias("total_users"), F.count_if(_pays()).alias("payers")
    ).withColumn("payers_share", ratio(F.col("payers"), F.col("total_users")))


def payer_share_by_race(users: DataFrame, race: DataFrame) -> DataFrame:
    """Users and payers per race; a race without payers is left out.

    Users are counted per ``race_id`` before the names are joined.
    """
    counts = users.groupBy("race_id").agg(
        F.count("race_id").alias("total"), F.count_if(_pays()).alias("paying")
    )
    return (
        race.join(counts, "race_id")
        .filter(F.col("race").isNotNull())
        .groupBy("race")
        .agg(
            F.sum("paying").alias("payers_in_race"),
            F.sum("total").alias("total_in_race"),
        )
        .filter(F.col("payers_in_race") > 0)
        .withColumn("payers_share", ratio(F.col("payers_in_race"), F.col("total_in_race")))
        .orderBy(F.desc("payers_share"), "race")
    )


def amount_stats(events: DataFrame) -> DataFrame:
    median = exact_percentiles(events, {"median": ("amount", 0.5)})
    return events.agg(
        F.count("transaction_id").alias("total_count"),
        F.sum("amount").alias("total_sum"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.avg("amount").alias("avg_amount"),
        F.stddev_samp("amount").alias("std"),
    ).withColumn("median", median.scalar())


def zero_purchases(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count_if(F.col("amount") == 0).alias("null_amount"), F.count("*").alias("total")
    ).select("null_amount", ratio(F.col("null_amount"), F.col("total")).alias("null_amount_share"))


def item_popularity(events: DataFrame, items: DataFrame) -> DataFrame:
    """Sales and buyers per item name, as shares of all sales and all buyers.

    Purchases are first counted per item and buyer, so the best-selling item is
    combined before it is shuffled. The totals cover purchases of unlisted
    items too.
    """
    sold = events.filter(F.col("amount") != 0)
    bought = sold.groupBy("item_code", "id").agg(F.count("*").alias("n"))
    totals = (
        sold.groupBy("id")
        .agg(F.count("*").alias("n"))
        .agg(F.struct(F.sum("n").alias("sales"), F.count("id").alias("buyers")).alias("total"))
        .scalar()
    )
    return (
        bought.join(items, "item_code")
        .filter(F.col("game_items").isNotNull())
        .groupBy("game_items", "id")
        .agg(F.sum("n").alias("n"))
        .groupBy("game_items")
        .agg(F.sum("n").alias("absolute_count"), F.count("id").alias("buyers"))
        .select(
            "game_items",
            "absolute_count",
            ratio(F.col("absolute_count"), totals["sales"]).alias("relative_count"),
            ratio(F.col("buyers"), totals["buyers"]).alias("users_item_share"),
        )
        .orderBy(F.desc("absolute_count"), "game_items")
    )


def race_report(events: DataFrame, users: DataFrame, race: DataFrame) -> DataFrame:
    """Users, customers, payers and spending per race, largest race first.

    Purchases are summed per buyer before they meet the users, and the users
    are joined to them once: every figure of a race follows from that join. A
    race without customers or without paying customers is left out. Events per
    person is a whole number.
    """
    spent = (
        events.filter((F.col("amount") != 0) & F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.count("*").alias("events"), F.sum("amount").alias("spent"))
    )
    members = (
        users.join(race, "race_id")
        .filter(F.col("race").isNotNull())
        .groupBy("id", "race")
        .agg(F.count("*").alias("rows"), F.bool_or(_pays()).alias("pays"))
    )
    bought = F.col("events").isNotNull()
    return (
        members.join(spent, "id", "left")
        .groupBy("race")
        .agg(
            F.count("id").alias("total_users"),
            F.count_if(bought).alias("total_customers"),
            F.count_if(bought & F.col("pays")).alias("total_payers"),
            F.sum(F.col("events") * F.col("rows")).alias("total_events"),
            F.avg(F.col("spent") / F.col("events")).alias("avg_cost_one1"),
            F.avg(F.col("spent") * F.col("rows")).alias("avg_cost_all"),
        )
        .filter(F.col("total_payers") > 0)
        .withColumn("events_per_person", F.expr("total_events div total_customers"))
        .select(
            "race",
            "total_users",
            "total_customers",
            "total_payers",
            ratio(F.col("total_customers"), F.col("total_users")).alias("customers_share"),
            ratio(F.col("total_payers"), F.col("total_customers")).alias("payers_share"),
            "events_per_person",
            "avg_cost_one1",
            (F.col("avg_cost_all") / F.col("events_per_person")).alias("avg_cost_one2"),
            "avg_cost_all",
        )
        .orderBy(F.desc("total_users"), "race")
    )


def users_preview(users: DataFrame, n: int = 5) -> DataFrame:
    """The first distinct users beside the number of rows of the table."""
    return with_total(
        preview(users.select(*USER_COLUMNS).distinct(), USER_COLUMNS, n), users
    )


def events_preview(events: DataFrame, n: int = 5) -> DataFrame:
    return with_total(preview(events, events.columns, n), events)


def users_by_server(users: DataFrame) -> DataFrame:
    return users.groupBy("server").agg(F.count("*").alias("row_count"))
