"""Listing analysis: outlier trim, market segments, seasonality, city ranking.

``id`` is the key of flats and of advertisements (at most one each). The reports
take the flats already trimmed. Stored, they are searched for limits once,
however many reports follow:

    with stored_relation(trimmed(flats), "kept-flats") as kept:
        segment_report(kept, city, ads)
        seasonality(kept, ads)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.bands import band
from tallyroom.functions.dates import plus_days
from tallyroom.functions.numbers import rounded
from tallyroom.operators.percentile import exact_percentiles

# The capital and the two region labels.
CAPITAL = "Санкт-Петербург"
REGION = "Ленинградская область"

# The segments by days on the market, both ends included.
SEGMENTS = [
    ("month", 1, 30),
    ("quarter", 31, 90),
    ("half year", 91, 180),
    ("more than half year", 181, None),
]

# The percentiles that bound each column.
LIMITS = {
    "total_area_limit": ("total_area", 0.99),
    "rooms_limit": ("rooms", 0.99),
    "balcony_limit": ("balcony", 0.99),
    "ceiling_height_limit_h": ("ceiling_height", 0.99),
    "ceiling_height_limit_l": ("ceiling_height", 0.01),
}


def limits(flats: DataFrame) -> DataFrame:
    return exact_percentiles(flats, LIMITS)


def trimmed(flats: DataFrame) -> DataFrame:
    """Flats strictly inside the limits. A missing value passes, but for the area.

    The limits are scalar subqueries over one row, so building the plan runs no job.
    """
    found = limits(flats)
    limit = {name: found.select(name).scalar() for name in LIMITS}

    def below(column: str) -> Column:
        return F.col(column) < limit[f"{column}_limit"]

    height = F.col("ceiling_height")
    inside = (height < limit["ceiling_height_limit_h"]) & (
        height > limit["ceiling_height_limit_l"]
    )
    return flats.filter(
        below("total_area")
        & (below("rooms") | F.col("rooms").isNull())
        & (below("balcony") | F.col("balcony").isNull())
        & (inside | height.isNull())
    )


def with_region(flats: DataFrame, city: DataFrame) -> DataFrame:
    """Flats with the capital told from the rest; an unknown city is the rest."""
    capital = city.filter(F.col("city") == CAPITAL).select("city_id", F.lit(CAPITAL).alias("part"))
    return (
        flats.join(capital.distinct(), "city_id", "left")
        .withColumn("city_part", F.coalesce("part", F.lit(REGION)))
        .drop("part")
    )


def exposition_segment(days: Column) -> Column:
    """How long a listing was up; NULL for unsold ones and for zero days."""
    return band(
        [
            (days.between(first, last) if last else days >= first, name)
            for name, first, last in SEGMENTS
        ]
    )


def segmented_ads(ads: DataFrame, kept: DataFrame) -> DataFrame:
    """Advertisements of the given flats with their segment."""
    return ads.join(kept, "id", "left_semi").withColumn(
        "seg", exposition_segment(F.col("days_exposition"))
    )


def segment_report(kept: DataFrame, city: DataFrame, ads: DataFrame) -> DataFrame:
    """Region by segment: counts, share within the region, prices, sizes."""
    sold = ads.select("id", "last_price", exposition_segment(F.col("days_exposition")).alias("seg"))
    area, price = F.col("total_area"), F.col("last_price")
    # The window sees one row per region and segment.
    region = Window.partitionBy("city_part")
    return (
        with_region(kept, city)
        .join(sold.filter(F.col("seg").isNotNull()), "id")
        .groupBy("city_part", "seg")
        .agg(
            F.count("*").alias("total_in_seg"),
            rounded(F.avg(price), 2).alias("avg_price"),
            rounded(F.avg(price / area), 2).alias("avg_price_per_sqm"),
            rounded(F.avg(area), 2).alias("avg_area"),
            rounded(F.avg("rooms"), 1).alias("avg_rooms"),
            rounded(F.avg(F.when(F.col("balcony") > 0, 1.0).otherwise(0.0)) * 100, 2).alias(
                "balcony_percentage"
            ),
        )
        .withColumn(
            "total_in_seg_per",
            rounded(
                F.col("total_in_seg") * 100.0 / F.sum("total_in_seg").over(region), 2
            ),
        )
        .orderBy("city_part", "seg")
    )


def seasonality(kept: DataFrame, ads: DataFrame) -> DataFrame:
    """Per month of publication: listings, removals, both ranked, and prices.

    Listings are counted once per pair of publication and removal
    month, at most 13 x 13 groups; months, ranks and means follow from those.
    Flats with one id count as one listing in the first four and as one joined
    row each in ``transactions_count`` and the means.
    """
    area, price = F.col("total_area"), F.col("last_price")
    published = F.month("first_day_exposition")
    removed = F.month(plus_days(F.col("first_day_exposition"), F.col("days_exposition")))
    # One row per id meets the advertisements: flats that share an id add to the
    # prices, as joined rows do, but an advertisement is listed once.
    per_id = kept.groupBy("id").agg(
        F.count("*").alias("joined"),
        F.min("total_area").alias("least_area"),
        F.sum("total_area").alias("areas"),
        F.count("total_area").alias("flats"),
        F.sum(F.try_divide(F.lit(1.0), area)).alias("per_area"),
        F.count(F.try_divide(F.lit(1.0), area)).alias("priced"),
    )
    per_area = F.when(F.col("joined") == 1, F.try_divide(price, F.col("least_area"))).otherwise(
        price * F.col("per_area")
    )
    pairs = (
        ads.join(per_id, "id")
        .groupBy(
            published.alias("published"),
            removed.alias("removed"),
            F.col("days_exposition").isNotNull().alias("is_removed"),
        )
        .agg(
            F.count("*").alias("n"),
            F.sum("joined").alias("joined"),
            F.sum(per_area).alias("price_sum"),
            F.sum(F.when(price.isNotNull(), F.col("priced")).otherwise(0)).alias("price_n"),
            F.sum("areas").alias("area_sum"),
            F.sum("flats").alias("area_n"),
        )
    )
    sums = ["joined", "price_sum", "price_n", "area_sum", "area_n"]
    as_published = F.struct(
        F.col("published").alias("month"), F.col("n").alias("publications"),
        F.lit(0).cast("long").alias("removals"), *[F.col(s) for s in sums],
    )
    as_removed = F.struct(
        F.col("removed").alias("month"), F.lit(0).cast("long").alias("publications"),
        F.when(F.col("is_removed"), F.col("n")).otherwise(0).alias("removals"),
        *[F.lit(0).cast(pairs.schema[s].dataType).alias(s) for s in sums],
    )
    months = (
        pairs.select(F.explode(F.array(as_published, as_removed)).alias("m"))
        .select("m.*")
        .groupBy("month")
        .agg(*[F.sum(c).alias(c) for c in ["publications", "removals", *sums]])
    )

    def rank(count: str) -> Column:
        # At most 13 rows, one per month, reach this unpartitioned window.
        return F.rank().over(Window.orderBy(F.desc(count)))

    # A missing month equals no other, so it gets neither removals nor prices.
    known = F.col("month").isNotNull()
    gone = known & (F.col("removals") > 0)
    return (
        months.withColumn("publication_rank", rank("publications"))
        .withColumn("removal_rank", rank("removals"))
        .filter(F.col("publications") > 0)
        .select(
            F.col("month").alias("publication_month"),
            F.col("publications").alias("publications_count"),
            "publication_rank",
            F.when(gone, F.col("removals")).alias("removals_count"),
            F.when(gone, F.col("removal_rank")).alias("removal_rank"),
            F.when(known, rounded(F.try_divide("price_sum", "price_n"), 2)).alias(
                "avg_price_per_sqm"
            ),
            F.when(known, rounded(F.try_divide("area_sum", "area_n"), 2)).alias("avg_total_area"),
            F.when(known, F.col("joined")).alias("transactions_count"),
        )
        .orderBy(F.col("publication_month").asc_nulls_last())
    )


def city_ranking(kept: DataFrame, city: DataFrame, ads: DataFrame, k: int = 10) -> DataFrame:
    """The cities outside the capital with most listings; ties go by name.

    Listings are summed per ``city_id`` before they meet the names, so a city
    with a third of them is one row in those joins.
    """
    days, area = F.col("days_exposition"), F.col("total_area")
    price = F.col("last_price") / area
    sums = {
        "cnt_amount": F.count("*"), "sold": F.count(days), "days": F.sum(days), "price": F.sum(price),
        "prices": F.count(price), "area": F.sum(area), "areas": F.count(area),
    }
    per_id = (
        kept.filter(F.col("id").isNotNull())
        .join(ads, "id", "left")
        .groupBy("city_id")
        .agg(*[value.alias(name) for name, value in sums.items()])
    )
    return (
        with_region(per_id, city)
        .filter(F.col("city_part") == REGION)
        .join(city, "city_id", "left")
        .groupBy("city")
        .agg(*[F.sum(name).alias(name) for name in sums])
        .select(
            "city",
            "cnt_amount",
            rounded(F.col("sold") * 100.0 / F.col("cnt_amount"), 2).alias("share_sold"),
            rounded(F.try_divide("price", "prices"), 2).alias("avg_price_per_sqm"),
            rounded(F.try_divide("area", "areas"), 2).alias("avg_area"),
            rounded(F.try_divide("days", "sold"), 2).alias("avg_days_publication"),
        )
        .orderBy(F.desc("cnt_amount"), F.col("city").asc_nulls_last())
        .limit(k)
    )
