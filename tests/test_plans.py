"""Shapes of the physical plans."""

from __future__ import annotations

from pathlib import Path

import pytest
from frames import in_spark, random_tables

from tallyroom.plans import game, game_sales, realty, telecom
from tallyroom.registry import queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()
NEVER = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
    "MapInPandas", "FlatMapGroupsInPandas",
)

with_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no driver tables here")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "no broadcast"])
def threshold(request, spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, request.param)
    yield request.param
    for key in keys:
        spark.conf.unset(key)


@with_tables
@pytest.mark.parametrize("key", QUERIES)
def test_no_cross_join_and_no_python(spark, threshold, key):
    plan = plan_of(QUERIES[key](spark, SF_DIR))
    assert not [node for node in NEVER if node in plan]


@with_tables
def test_columns_are_pruned(spark):
    plan = plan_of(QUERIES["tel_monthly_sms"](spark, SF_DIR))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The random tables as parquet, as a cluster would hold them."""
    folder = tmp_path_factory.mktemp("stored")
    frames = in_spark(spark, random_tables(1))
    for name, df in vars(frames).items():
        df.write.parquet(str(folder / name))
        setattr(frames, name, spark.read.parquet(str(folder / name)))
    return frames


@pytest.mark.parametrize(
    ("report", "pushed"),
    [
        (lambda t: game.item_popularity(t.g_events, t.g_items), "Not(EqualTo(amount,0.0))"),
        (lambda t: telecom.multi_tariff_users(t.tel_users), "IsNull(churn_date)"),
        (lambda t: realty.segment_report(t.re_flats, t.re_city, t.re_ads), "IsNotNull(id)"),
        (lambda t: game_sales.top_platforms(t.raw_games), "IsNotNull(year_of_release)"),
    ],
)
def test_filters_reach_the_scan(stored, report, pushed):
    assert pushed in plan_of(report(stored))


def shuffles(df) -> int:
    return plan_of(df).count("Exchange hashpartitioning")


def test_month_stats_shuffle_once(stored):
    stats = telecom.user_month_stats(stored.tel_calls, stored.tel_internet, stored.tel_messages)
    plan = plan_of(stats)
    assert shuffles(stats) == 1
    assert "Join" not in plan
    assert plan.count("partial_sum") >= 3


def test_race_report_joins_users_once(stored):
    report = game.race_report(stored.g_events, stored.g_users, stored.g_race)
    plan = plan_of(report)
    assert plan.count("/g_events") == 1
    assert plan.count("/g_users") == 1


def test_seasonality_reads_each_table_once_beside_the_limits(stored):
    report = realty.seasonality(realty.trimmed(stored.re_flats), stored.re_ads)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("/re_ads") <= 1
    assert jobs_while(lambda: realty.trimmed(stored.re_flats), stored.re_flats.sparkSession) == 0


def jobs_while(build, spark) -> int:
    """Spark jobs that building a plan starts."""
    context = spark.sparkContext
    context.setJobGroup("building", "plans only")
    try:
        build()
        return len(context.statusTracker().getJobIdsForGroup("building"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_building_the_reports_runs_no_job(stored):
    spark = stored.re_flats.sparkSession

    def build():
        kept = realty.trimmed(stored.re_flats)
        realty.segmented_ads(stored.re_ads, kept)
        realty.segment_report(kept, stored.re_city, stored.re_ads)
        realty.seasonality(kept, stored.re_ads)
        realty.city_ranking(kept, stored.re_city, stored.re_ads)

    stored.re_city, stored.re_ads  # noqa: B018  opened beforehand
    assert jobs_while(build, spark) == 0


def test_limits_are_found_when_the_plan_runs(stored):
    plan = realty.trimmed(stored.re_flats)._jdf.queryExecution().executedPlan().toString()
    assert "(total_area" in plan and "< Subquery" in plan
    assert "PushedFilters: [IsNotNull(total_area)]" in plan


def test_limits_move_counts_only(stored):
    """Each pass combines its counts before the shuffle."""
    stats = game.amount_stats(stored.g_events)
    stats.collect()
    plan = plan_of(stats)
    assert "partial_count" in plan and "percentile" not in plan
