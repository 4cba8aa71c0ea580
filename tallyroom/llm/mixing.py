"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A source's target in words divided by its size is the number of copies each of
its documents should get. The whole part is certain. The rest is a probability:
documents are ranked by their random odds over the odds of inclusion, and are
taken in that order until the rest of the target is filled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.common import WORD, fresh, stored

#: Bins that locate a source's last document, in two steps; the rows left to
#: sort are about those of one bin of the second step.
BINS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_odds(key: Column, text: Column) -> Column:
    """Odds of a uniform number that follows from the document alone, so that reruns agree."""
    seen = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(" "), F.coalesce(text, F.lit("")))
    digits = F.conv(F.substring(F.md5(seen.cast("binary")), 1, 13), 16, 10).cast("double")
    uniform = (digits + 0.5) / float(1 << 52)
    return uniform / (1 - uniform)


def numbered(values: DataFrame, column: str) -> DataFrame:
    """``values`` with ``position``, from 0 in the order of ``column``, nulls last; no task sees all rows."""
    spread = stored(
        values.repartitionByRange(F.asc_nulls_last(column)).withColumn("part", F.spark_partition_id()), "order"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    parts = spread.groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last(column)))
    return spread.withColumn("inside", inside).join(parts, "part").select(
        *values.columns, (F.col("skipped") + F.col("inside") - 1).alias("position")
    )


def targets(sizes: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """``source, source_size, target, whole, rest`` from ``source, source_size``.

    All sources share the sum of all sizes by weight. A target stops at
    ``most`` times its source's size, and the others share what is over.
    """
    given = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(given, (F.col("position") % len(weights) + 1).cast("int"))
    sources = stored(numbered(sizes, "source").select("source", "source_size", weight.alias("weight")), "sources")
    full = most * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    per_weight = 0.0
    capped = F.lit(False)
    while True:
        # Three numbers a round; a round caps at least one more source.
        row = sources.agg(
            F.sum(F.when(capped, full).otherwise(0)), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        share = (total - row[0]) / row[1] if row[1] else per_weight
        if share <= per_weight:
            break
        per_weight = share
        capped = full <= F.lit(per_weight) * F.col("weight")
    target = F.when(capped, full.cast("double")).otherwise(F.lit(per_weight) * F.col("weight"))
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    return sources.select("source", "source_size", target.alias("target")).select(
        "*", whole.alias("whole"), F.greatest(F.col("target") - whole * size, F.lit(0.0)).alias("rest")
    )


def _rank(odds: Column, rest: Column, source_size: Column) -> Column:
    """The Pareto ranking variable, mapped to 0 to 1; null where no document gets a further copy."""
    chance = F.when(rest > 0, rest / source_size)
    ratio = odds * (1 - chance) / chance
    return ratio / (1 + ratio)


def _bins(rank: Column) -> tuple[Column, Column]:
    fine = F.floor(rank * (BINS * BINS))
    return F.floor(fine / BINS), F.pmod(fine, F.lit(BINS))


def _last_bin(rows: DataFrame, by: str, before: Column) -> DataFrame:
    """Per source the first bin in which its words reach ``rest``, and the words ahead of that bin."""
    upto = F.sum("words").over(Window.partitionBy("source").orderBy(by))
    sums = rows.groupBy("source", by).agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first(before).alias("ahead")
    )
    reached = sums.withColumn("upto", F.col("ahead") + upto).filter(F.col("upto") >= F.col("rest"))
    return reached.groupBy("source").agg(
        F.min(F.struct(by, (F.col("upto") - F.col("words")).alias("ahead"))).alias("at")
    ).select("source", f"at.{by}", "at.ahead")


def _same(left: DataFrame, right: DataFrame, how: str = "inner", *more: str) -> DataFrame:
    """A join on ``source``, null being a source like any other, and further columns."""
    on = left["source"].eqNullSafe(right["source"])
    for c in more:
        on = on & (left[c] == right[c])
    return left.join(right, on, how).drop(right["source"], *[right[c] for c in more])


def cuts(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` and, per source, ``upto``: documents with a rank up to it get one more copy."""
    ranked = _same(sized, goals).withColumn("rank", _rank(F.col("odds"), F.col("rest"), F.col("source_size"))).filter("rank is not null")
    coarse, fine = _bins(F.col("rank"))
    ranked = ranked.select("source", "size", "rest", "rank", coarse.alias("coarse"), fine.alias("fine"))
    first = _last_bin(ranked, "coarse", F.lit(0))
    inside = _same(ranked, first, "inner", "coarse")
    second = _last_bin(inside, "fine", F.col("ahead"))
    last = _same(inside.drop("ahead"), second, "inner", "fine")
    # The rows of one bin of the second step. A document is taken if more than
    # half of it still fits, so the sum is off by half a document at most.
    order = Window.partitionBy("source").orderBy("rank")
    passed = F.sum("size").over(order.rangeBetween(Window.unboundedPreceding, 0)) - F.sum("size").over(
        order.rangeBetween(0, 0)
    )
    same = F.sum("size").over(order.rangeBetween(0, 0))
    edge = (F.col("coarse") * BINS + F.col("fine")) / float(BINS * BINS)
    ends = (
        last.withColumn("fits", F.col("ahead") + passed + same / 2 < F.col("rest"))
        .groupBy("source")
        .agg(F.max(F.when(F.col("fits"), F.col("rank"))).alias("upto"), F.min(edge).alias("edge"))
    )
    return _same(goals, ends, "left")


def with_copies(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> tuple[DataFrame, list[str]]:
    """``docs`` with size, source size, target and number of copies, and the names of these four columns.

    Only sizes and random numbers are kept between the passes; the texts are
    read twice and meet one row per source.
    """
    size, source_size, target, copies, odds, whole, rest, upto, edge, mine = fresh(
        docs, "size", "source_size", "target", "copies", "odds", "whole", "rest", "upto", "edge", "source"
    )
    measures = [word_count(F.col(f"`{text}`")), random_odds(F.col(f"`{key}`"), F.col(f"`{text}`"))]
    sized = stored(
        docs.select(F.col(f"`{source}`").alias("source"), measures[0].alias("size"), measures[1].alias("odds")),
        "sizes",
    )
    goals = stored(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets"
    )
    # One row per source, as a table, so that Spark knows its size.
    ends = stored(cuts(sized, goals), "cuts")
    ends = ends.toDF(*[{"source": "of"}.get(c, c) for c in ends.columns])
    ends = ends.select(
        F.col("of").alias("_of" + mine),
        F.col("source_size").alias(source_size),
        F.col("target").alias(target),
        F.col("whole").alias(whole),
        F.col("rest").alias(rest),
        F.col("upto").alias(upto),
        F.col("edge").alias(edge),
    )
    measured = docs.withColumns({size: measures[0], odds: measures[1]})
    joined = measured.join(ends, measured[f"`{source}`"].eqNullSafe(ends["_of" + mine]), "left")
    rank = _rank(F.col(odds), F.col(rest), F.col(source_size))
    more = F.when((rank < F.col(edge)) | (rank <= F.col(upto)), 1).otherwise(0)
    result = joined.withColumn(copies, F.col(whole) + more)
    return result, [size, source_size, target, copies]


def mixture(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """Per document: the key, ``size, source_size, target, taken``, the last being the words the mix takes.

    A null or blank text has size 0 and takes nothing. Rows that agree in key
    and text have the same rank and are taken or left together. An empty table
    gives an empty table.
    """
    counted, (size, source_size, target, copies) = with_copies(docs, text=text, key=key, source=source, **options)
    return counted.select(
        F.col(f"`{key}`"),
        F.col(size).alias("size"),
        F.col(source_size).alias("source_size"),
        F.col(target).alias("target"),
        (F.col(size) * F.col(copies)).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    counted, (*_, copies) = with_copies(docs, **options)
    (copy,) = fresh(counted, "copy")
    times = F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))
    return counted.withColumn(copy, times).select(*[F.col(f"`{c}`") for c in docs.columns])


#: The contract's mixture in DuckDB.
SQL = r"""
with sized as (
    select doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
           (('0x' || substr(md5(coalesce(doc_id::varchar, '') || ' ' || coalesce(text, '')), 1, 13))::bigint::double
            + 0.5) / 4503599627370496.0 as u
    from documents
),
sources as (
    select source, sum(size)::bigint as source_size,
           [5.0::double, 2.0::double, 1.0::double][
               ((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
    from sized group by source
),
-- Sources fill up in the order of their size over their weight.
filled as (
    select *, sum(source_size) over () as total,
           coalesce(sum(3 * source_size) over before, 0) as full_before,
           sum(weight) over (order by 3 * source_size / weight, source nulls last
                             rows between current row and unbounded following) as weight_left
    from sources
    window before as (order by 3 * source_size / weight, source nulls last
                      rows between unbounded preceding and 1 preceding)
),
levels as (
    select *, (total - full_before)::double / weight_left as level,
           3 * source_size <= (total - full_before)::double / weight_left * weight as is_full
    from filled
),
share as (select max(case when not is_full then level end) as per_weight from levels),
goals as (
    select source, source_size,
           case when is_full then (3 * source_size)::double else per_weight * weight end as target
    from levels, share
),
parts as (
    select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from goals
),
rests as (select *, greatest(target - whole * source_size, 0) as rest from parts),
ranked as (
    select s.doc_id, s.size, r.*,
           case when rest > 0
                then (s.u / (1 - s.u)) * (1 - rest / source_size) / (rest / source_size) end as ratio
    from sized s join rests r on s.source is not distinct from r.source
),
run as (
    select *, sum(size) over (partition by source order by ratio range between unbounded preceding and current row)
              - sum(size) over (partition by source order by ratio range between current row and current row) as passed,
           sum(size) over (partition by source order by ratio range between current row and current row) as same
    from ranked
)
select doc_id, size, source_size, target,
       (size * (whole + case when rest > 0 and passed + same / 2.0 < rest then 1 else 0 end))::bigint as taken
from run
"""
