"""Stored relations: computed once, read by several reports, gone afterwards."""

from __future__ import annotations

import glob
from pathlib import Path

import pytest
from frames import in_spark, random_tables

from tallyroom.plans import realty, telecom
from tallyroom.session import scratch_path
from tallyroom.sources.relations import bucketed_relation, stored_relation


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    frames = in_spark(spark, random_tables(5))
    for name, df in vars(frames).items():
        df.write.parquet(str(folder / name))
        setattr(frames, name, spark.read.parquet(str(folder / name)))
    return frames


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[str]:
    return sorted(str(tuple(r)) for r in df.collect())


def left_in_scratch(spark, name: str) -> list[str]:
    return glob.glob(f"{Path(scratch_path(spark, 'x')).parent}/{name}-*")


def test_reports_read_a_stored_relation_only(spark, tables):
    kept = realty.trimmed(tables.re_flats)
    reports = [
        lambda k: realty.segment_report(k, tables.re_city, tables.re_ads),
        lambda k: realty.seasonality(k, tables.re_ads),
        lambda k: realty.city_ranking(k, tables.re_city, tables.re_ads),
    ]
    with stored_relation(kept, "kept-flats") as stored:
        assert stored.schema == kept.schema
        for report in reports:
            assert "/re_flats" in plan_of(report(kept))
            assert "/re_flats" not in plan_of(report(stored))
            assert plan_of(report(stored)).count("/kept-flats") == 1
            assert rows(report(stored)) == rows(report(kept))
        assert left_in_scratch(spark, "kept-flats")
    assert not left_in_scratch(spark, "kept-flats")


def test_a_relation_goes_when_its_reader_fails(spark, tables):
    with pytest.raises(ZeroDivisionError), stored_relation(tables.re_city, "city") as stored:
        assert stored.count() == tables.re_city.count()
        raise ZeroDivisionError
    assert not left_in_scratch(spark, "city")
    with pytest.raises(ZeroDivisionError), bucketed_relation(tables.re_city, "city", ["city_id"], 4):
        assert any(t.name.startswith("city_") for t in spark.catalog.listTables())
        raise ZeroDivisionError
    assert not any(t.name.startswith("city_") for t in spark.catalog.listTables())


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def by_user(plan: str) -> int:
    """Shuffles by user in a plan, other than of copies or by tariff."""
    return plan.count("Exchange hashpartitioning(user_id")


def test_user_months_join_without_a_shuffle(spark, tables, no_broadcast):
    stats = telecom.user_month_stats(tables.tel_calls, tables.tel_internet, tables.tel_messages)
    users, tariffs = tables.tel_users, tables.tel_tariffs
    joins = [telecom.overage, telecom.month_cost, telecom.avg_cost_by_tariff, telecom.overcost_by_tariff]
    with telecom.bucketed_by_user(stats, users, 8) as (months, held):
        for report in joins:
            plan = plan_of(report(months, held, tariffs))
            assert by_user(plan_of(report(stats, users, tariffs))) > 0
            assert by_user(plan) == 0, plan
            assert rows(report(months, held, tariffs)) == rows(report(stats, users, tariffs))


def test_empty_relations(spark, tables):
    none = tables.tel_users.limit(0)
    with stored_relation(none, "none") as stored:
        assert stored.schema == none.schema and stored.count() == 0
    with bucketed_relation(none, "none", ["user_id"], 4) as stored:
        assert stored.columns == none.columns and stored.count() == 0
