"""Every analysis by key, over the views of one data folder.

The analyses return full doubles; sums and means of doubles differ in their
last bits with the order of summation, so the keys here round them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.functions.numbers import rounded
from tallyroom.functions.text import snake_case_columns
from tallyroom.operators import keys, profile
from tallyroom.plans import game, game_sales, realty, telecom
from tallyroom.session import remove_at_exit, scratch_path
from tallyroom.sources.csv_file import read_csv
from tallyroom.sources.game_sales import HEADER, with_file_header, write_games_csv
from tallyroom.sources.tables import Views, table, table_names

#: The tables among which references are looked for.
REFERRING = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, scale: int, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), scale) for c in columns})


def _stats(v: Views) -> DataFrame:
    return telecom.user_month_stats(v.tel_calls, v.tel_internet, v.tel_messages)


def _telecom() -> dict[str, Callable[[Views], DataFrame]]:
    t = telecom
    month = ["user_id", "dt_month"]
    whole = {
        "tel_monthly_minutes": lambda v: t.monthly_minutes(v.tel_calls),
        "tel_monthly_traffic": lambda v: _round(
            t.monthly_traffic(v.tel_internet), 4, "month_mb_traffic"
        ),
        "tel_monthly_sms": lambda v: t.monthly_sms(v.tel_messages),
        "tel_activity_months": lambda v: t.activity_months(
            v.tel_calls, v.tel_internet, v.tel_messages
        ),
        "tel_user_month_stats": lambda v: _round(_stats(v), 4, "month_mb_traffic"),
        "tel_overage": lambda v: _round(
            t.overage(_stats(v), v.tel_users, v.tel_tariffs), 4,
            "month_mb_traffic", "gb_traffic_over",
        ),
        "tel_month_cost": lambda v: _round(
            t.month_cost(_stats(v), v.tel_users, v.tel_tariffs), 4,
            "month_mb_traffic", "total_cost",
        ),
    }
    # The first rows of the larger results, as their reports show them.
    shown = {
        "tel_activity_months": (month, 5),
        "tel_user_month_stats": (month, 10),
        "tel_overage": ([*month, "tariff"], 10),
        "tel_month_cost": ([*month, "tariff"], 10),
    }
    first = {
        f"{key}_first{n}": lambda v, key=key, order=order, n=n: profile.preview(
            whole[key](v), order, n
        )
        for key, (order, n) in shown.items()
    }
    return {
        "tel_preview_users": lambda v: profile.preview(v.tel_users, ["user_id", "tariff"], 20),
        "tel_users_any_null": lambda v: profile.preview(
            t.users_any_null(v.tel_users), ["user_id", "tariff"], 10
        ),
        "tel_active_share": lambda v: _round(t.active_share(v.tel_users), 8, "share"),
        "tel_multi_tariff_users": lambda v: t.multi_tariff_users(v.tel_users),
        "tel_calls_null_rows": lambda v: t.calls_null_rows(v.tel_calls),
        "tel_call_duration_range": lambda v: t.call_duration_range(v.tel_calls),
        "tel_missed_call_share": lambda v: _round(t.missed_call_share(v.tel_calls), 8, "share"),
        "tel_top_daily_talk": lambda v: _round(
            t.top_daily_talk(v.tel_calls), 6, "total_day_duration"
        ),
        **whole,
        **first,
        "tel_avg_cost_by_tariff": lambda v: t.avg_cost_by_tariff(
            _stats(v), v.tel_users, v.tel_tariffs
        ),
        "tel_overcost_by_tariff": lambda v: t.overcost_by_tariff(
            _stats(v), v.tel_users, v.tel_tariffs
        ),
    }


def _realty() -> dict[str, Callable[[Views], DataFrame]]:
    r = realty
    return {
        "re_limits": lambda v: r.limits(v.re_flats).select(
            *[F.col(name).cast("double").alias(name) for name in r.LIMITS]
        ),
        "re_filtered_ids": lambda v: r.trimmed(v.re_flats).select("id"),
        "re_region_label": lambda v: r.with_region(v.re_flats, v.re_city),
        "re_exposition_segment": lambda v: r.segmented_ads(v.re_ads, r.trimmed(v.re_flats)),
        "re_segment_report": lambda v: r.segment_report(
            r.trimmed(v.re_flats), v.re_city, v.re_ads
        ),
        "re_seasonality": lambda v: r.seasonality(r.trimmed(v.re_flats), v.re_ads),
        "re_city_ranking": lambda v: r.city_ranking(r.trimmed(v.re_flats), v.re_city, v.re_ads),
    }


def _game() -> dict[str, Callable[[Views], DataFrame]]:
    g = game
    return {
        "game_payer_share": lambda v: _round(g.payer_share(v.g_users), 8, "payers_share"),
        "game_payer_share_by_race": lambda v: _round(
            g.payer_share_by_race(v.g_users, v.g_race), 8, "payers_share"
        ),
        "game_amount_stats": lambda v: _round(
            g.amount_stats(v.g_events), 2, "total_sum", "avg_amount", "std"
        ),
        "game_zero_purchases": lambda v: _round(
            g.zero_purchases(v.g_events), 8, "null_amount_share"
        ),
        "game_item_popularity": lambda v: _round(
            g.item_popularity(v.g_events, v.g_items), 8, "relative_count", "users_item_share"
        ),
        "game_race_report": lambda v: _round(
            _round(
                g.race_report(v.g_events, v.g_users, v.g_race), 8,
                "customers_share", "payers_share",
            ),
            2, "avg_cost_one1", "avg_cost_one2", "avg_cost_all",
        ),
        "cat_columns_users": lambda v: profile.column_catalogue(v.g_users, "g_users"),
        "cat_columns_events": lambda v: profile.column_catalogue(v.g_events, "g_events"),
        "game_users_preview": lambda v: g.users_preview(v.g_users),
        "game_users_null_count": lambda v: profile.null_row_count(v.g_users, g.USER_CHECKED),
        "game_users_by_server": lambda v: g.users_by_server(v.g_users),
        "game_events_preview": lambda v: g.events_preview(v.g_events),
        "game_events_null_count": lambda v: profile.null_row_count(
            v.g_events, list(g.EVENT_CHECKED)
        ),
        "game_events_null_breakdown": lambda v: profile.filled_among_incomplete(
            v.g_events, g.EVENT_CHECKED
        ),
    }


def load_through_csv(v: Views) -> DataFrame:
    """The sales table written as CSV to the shared folder and loaded from it, rows numbered by place.

    Types are stated: what a file without rows, or with odd ones, would have inferred may differ.
    """
    games = v.raw_games
    path = scratch_path(games.sparkSession, "games-csv")
    write_games_csv(with_file_header(games), path)
    remove_at_exit(games.sparkSession, path)
    return read_csv(games.sparkSession, path, types=HEADER, position="row_id")


def top_platforms_of_file(v: Views) -> DataFrame:
    """The whole chain, from the file to the top platforms."""
    return game_sales.top_platforms(snake_case_columns(load_through_csv(v)))


def _sales() -> dict[str, Callable[[Views], DataFrame]]:
    s = game_sales

    def by_name(df: DataFrame) -> DataFrame:
        return df.drop(s.POSITION)

    return {
        "nb_load": load_through_csv,
        "nb_preview": lambda v: profile.preview(with_file_header(v.raw_games), [s.POSITION], 5),
        "nb_info": lambda v: profile.frame_info(by_name(with_file_header(v.raw_games))),
        "nb_info_typed": lambda v: profile.frame_info(by_name(s.typed(v.raw_games))),
        "nb_name_style": lambda v: profile.name_styles(by_name(with_file_header(v.raw_games))),
        "nb_snake_case": lambda v: snake_case_columns(with_file_header(v.raw_games)),
        "nb_year_fix": lambda v: s.fix_year(v.raw_games),
        "nb_numeric_fix": lambda v: s.typed(v.raw_games),
        "nb_null_profile": lambda v: profile.null_profile(by_name(s.typed(v.raw_games))),
        "nb_score_sentinel": lambda v: s.fill_scores(s.typed(v.raw_games)),
        "nb_group_mean_impute": lambda v: _round(
            s.impute_sales(s.fill_scores(s.typed(v.raw_games))), 6, "eu_sales", "jp_sales"
        ),
        "nb_label_fill": lambda v: s.filled(v.raw_games),
        "nb_cardinality": lambda v: s.distinct_counts(v.raw_games),
        "nb_dup_flags": lambda v: s.duplicate_flags(v.raw_games),
        "nb_distinct_values": lambda v: s.sorted_values(v.raw_games),
        "nb_dedup": lambda v: s.deduplicated(v.raw_games),
        "nb_case_fold": lambda v: s.cleaned(v.raw_games),
        "nb_case_fold_counts": lambda v: s.folded_counts(v.raw_games),
        "nb_removed_rows": lambda v: s.removed_rows(v.raw_games),
        "nb_period": lambda v: s.in_period(s.cleaned(v.raw_games)),
        "nb_user_category": lambda v: s.period_games(v.raw_games).drop("critic_category"),
        "nb_critic_category": lambda v: s.period_games(v.raw_games).drop("user_category"),
        "nb_top_platforms": lambda v: s.top_platforms(v.raw_games),
        "nb_file_to_top_platforms": top_platforms_of_file,
    }


def analyses() -> dict[str, Callable[[Views], DataFrame]]:
    """By key, what to compute from an object with the views as attributes."""
    return {**_telecom(), **_realty(), **_game(), **_sales()}


def queries() -> dict[str, Query]:
    def over_views(analysis: Callable[[Views], DataFrame]) -> Query:
        return lambda spark, sf_dir: analysis(Views(spark, sf_dir))

    return {
        **{key: over_views(analysis) for key, analysis in analyses().items()},
        "cat_tables": lambda spark, sf_dir: profile.row_counts(
            {name: table(spark, sf_dir, name) for name in table_names(spark, sf_dir)}
        ),
        "cat_keys_lineitem": lambda spark, sf_dir: keys.unique_sets(
            table(spark, sf_dir, "lineitem"), "lineitem", most=2
        ),
        "cat_references": lambda spark, sf_dir: keys.references(
            {name: table(spark, sf_dir, name) for name in REFERRING}
        ),
    }
