"""The same results in SQL for DuckDB, written independently of the Spark plans.

Where a Spark plan takes a shortcut (one stacked aggregate, weights, a joined
summary), the SQL here takes the long way of separate subqueries and joins.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from itertools import combinations

from tallyroom.sources.tables import TABLES
from tallyroom.sources.view_sql import VIEW_SQL, in_duckdb


def with_steps(body: str, views: Mapping[str, str]) -> str:
    """Prefix ``body`` with the views and the named steps it mentions."""
    known = {**{k: in_duckdb(s) for k, s in views.items()}, **STEPS}
    used: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(known[name])
                used.append(name)

    visit(body)
    ctes = ",\n".join(f"{name} as ({known[name]})" for name in used)
    return f"with {ctes}\n{body}" if used else body


def half_up(value: str, scale: int) -> str:
    """Infinity, NaN and numbers from 1e27 on stay as they are."""
    number = f"cast({value} as double)"
    return (
        f"(case when abs({number}) < 1e27 "
        f"then cast(round(try_cast({value} as decimal(38,10)), {scale}) as double) else {number} end)"
    )


def _number(text: str) -> str:
    dotted = f"replace({text}, ',', '.')"
    return (
        f"case when regexp_matches(trim({dotted}), "
        f"'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') "
        f"then cast(trim({dotted}) as double) end"
    )


def _title(text: str) -> str:
    runs = rf"regexp_extract_all(lower({text}), '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || r[2:]), '')"


def _month(column: str) -> str:
    return f"cast(date_trunc('month', {column}) as date)"


_GAMES = (
    "name", "platform", "year_of_release", "genre", "na_sales", "eu_sales", "jp_sales",
    "other_sales", "critic_score", "user_score", "rating",
)
_HEADER = (
    "Name", "Platform", "Year of Release", "Genre", "NA sales", "EU sales", "JP sales",
    "Other sales", "Critic Score", "User Score", "Rating",
)
_RAW_TYPES = dict(
    zip(_GAMES, ("string", "string", "double", "string", "double", "string", "string",
                 "double", "double", "string", "string"))
)
_TYPED_TYPES = {
    **_RAW_TYPES, "year_of_release": "int", "eu_sales": "double", "jp_sales": "double",
    "user_score": "double",
}

_GRADE = """case when {c} >= {b} and {c} <= {d} then 'высокая оценка'
                 when {c} >= {a} and {c} < {b} then 'средняя оценка'
                 when {c} >= 0 and {c} < {a} then 'низкая оценка' end"""

STEPS: dict[str, str] = {
    "call_months": f"""
        select user_id, {_month('call_date')} as dt_month,
               cast(ceil(sum(duration)) as bigint) as month_duration
        from tel_calls group by all""",
    "net_months": f"""
        select user_id, {_month('session_date')} as dt_month, sum(mb_used) as month_mb_traffic
        from tel_internet group by all""",
    "sms_months": f"""
        select user_id, {_month('message_date')} as dt_month, count(*) as month_sms
        from tel_messages group by all""",
    "any_months": """
        select user_id, dt_month from call_months
        union select user_id, dt_month from net_months
        union select user_id, dt_month from sms_months""",
    "stat_rows": """
        select x.user_id, x.dt_month, c.month_duration, n.month_mb_traffic, s.month_sms
        from any_months x
        left join call_months c on c.user_id = x.user_id and c.dt_month = x.dt_month
        left join net_months n on n.user_id = x.user_id and n.dt_month = x.dt_month
        left join sms_months s on s.user_id = x.user_id and s.dt_month = x.dt_month""",
    "over_rows": """
        select r.*, u.tariff,
               coalesce(greatest(r.month_duration - p.minutes_included, 0), 0) as duration_over,
               coalesce(greatest(r.month_mb_traffic - p.mb_per_month_included, 0), 0) / 1024.0
                   as gb_traffic_over,
               coalesce(greatest(r.month_sms - p.messages_included, 0), 0) as sms_over,
               p.rub_monthly_fee, p.rub_per_minute, p.rub_per_gb, p.rub_per_message
        from stat_rows r left join tel_users u on u.user_id = r.user_id
        left join tel_tariffs p on p.tariff_name = u.tariff""",
    "cost_rows": """
        select *, rub_monthly_fee + rub_per_minute * duration_over
                  + rub_per_gb * gb_traffic_over + rub_per_message * sms_over as total_cost
        from over_rows""",
    "active_cost_rows": """
        select c.* from cost_rows c left join tel_users holder on holder.user_id = c.user_id
        where holder.churn_date is null""",
    "edges": """
        select cast(quantile_disc(total_area, 0.99) as double) as total_area_limit,
               cast(quantile_disc(rooms, 0.99) as double) as rooms_limit,
               cast(quantile_disc(balcony, 0.99) as double) as balcony_limit,
               cast(quantile_disc(ceiling_height, 0.99) as double) as ceiling_height_limit_h,
               cast(quantile_disc(ceiling_height, 0.01) as double) as ceiling_height_limit_l
        from re_flats""",
    "kept_flats": """
        select f.* from re_flats f, edges
        where f.total_area < total_area_limit
          and coalesce(f.rooms < rooms_limit, f.rooms is null)
          and coalesce(f.balcony < balcony_limit, f.balcony is null)
          and coalesce(f.ceiling_height < ceiling_height_limit_h
                       and f.ceiling_height > ceiling_height_limit_l, f.ceiling_height is null)""",
    "kept_ads": "select * from re_ads where id in (select id from kept_flats)",
    "part_rows": """
        select f.*, case when f.city_id in (select city_id from re_city
                                            where city = 'Санкт-Петербург')
                         then 'Санкт-Петербург' else 'Ленинградская область' end as city_part
        from re_flats f""",
    "seg_rows": """
        select *, case when days_exposition >= 181 then 'more than half year'
                       when days_exposition >= 91 then 'half year'
                       when days_exposition >= 31 then 'quarter'
                       when days_exposition >= 1 then 'month' end as seg
        from kept_ads""",
    "listed_months": """
        select m, n, rank() over (order by n desc) as r from (
            select cast(month(first_day_exposition) as int) as m, count(*) as n
            from kept_ads group by all) a""",
    "delisted_months": """
        select m, n, rank() over (order by n desc) as r from (
            select cast(month(first_day_exposition + days_exposition) as int) as m,
                   count(*) as n
            from kept_ads where days_exposition is not null group by all) a""",
    "priced_months": """
        select cast(month(first_day_exposition) as int) as m, count(*) as n,
               avg(last_price / total_area) as per_sqm, avg(total_area) as area
        from kept_ads join kept_flats using (id) group by all""",
    "real_buys": "select * from g_events where amount <> 0",
    "race_buys": """
        select race, b.id, b.amount, u.payer from real_buys b
        join g_users u on u.id = b.id join g_race using (race_id)""",
    "race_members": """
        select race, count(distinct id) as total_users
        from g_users join g_race using (race_id) group by race""",
    "race_customers": """
        select race, count(distinct id) as total_customers, count(*) as total_events
        from race_buys group by race""",
    "race_payers": """
        select race, count(distinct id) as total_payers
        from race_buys where payer = 1 group by race""",
    "race_buyers": """
        select race, avg(mean) as mean_of_means, avg(spent) as mean_spent
        from (select race, id, avg(amount) as mean, sum(amount) as spent
              from race_buys group by race, id) per_buyer group by race""",
    "typed_games": f"""
        select row_id, name, platform, cast(year_of_release as int) as year_of_release, genre,
               na_sales, {_number('eu_sales')} as eu_sales, {_number('jp_sales')} as jp_sales,
               other_sales, critic_score, {_number('user_score')} as user_score, rating
        from raw_games where year_of_release is not null""",
    "scored_games": """
        select * replace (coalesce(critic_score, -1) as critic_score,
                          coalesce(user_score, -1) as user_score)
        from typed_games""",
    "filled_games": """
        select * replace (coalesce(name, 'NS') as name, coalesce(genre, 'NS') as genre,
                          coalesce(rating, 'NS') as rating)
        from scored_games""",
    "unique_games": f"""
        select min(row_id) as row_id, {', '.join(_GAMES)} from filled_games group by all""",
    "folded_games": f"""
        select * replace ({_title('genre')} as genre, upper(rating) as rating)
        from unique_games""",
    "period_rows": """
        select * from folded_games where year_of_release >= 2000 and year_of_release <= 2013""",
}


def _per_name(names, row, source: str) -> str:
    return " union all ".join(f"select {row(n)} from {source}" for n in names)


def _quoted_games() -> str:
    return ", ".join(f'{c} as "{h}"' for c, h in zip(_GAMES, _HEADER))


def _telecom() -> dict[str, str]:
    order = "order by user_id asc nulls last, dt_month asc nulls last"
    stats = f"""select user_id, dt_month, month_duration,
                       {half_up('month_mb_traffic', 4)} as month_mb_traffic, month_sms
                from stat_rows"""
    over = f"""select user_id, dt_month, tariff, month_duration,
                      {half_up('month_mb_traffic', 4)} as month_mb_traffic, month_sms,
                      cast(duration_over as bigint) as duration_over,
                      {half_up('gb_traffic_over', 4)} as gb_traffic_over,
                      cast(sms_over as bigint) as sms_over
               from over_rows"""
    cost = f"""select user_id, dt_month, tariff, month_duration,
                      {half_up('month_mb_traffic', 4)} as month_mb_traffic, month_sms,
                      rub_monthly_fee, {half_up('total_cost', 4)} as total_cost
               from cost_rows"""
    months = "select * from any_months"
    tariff = ", tariff asc nulls last"
    return {
        "tel_preview_users": "select * from tel_users order by user_id, tariff limit 20",
        "tel_users_any_null": """
            select * from tel_users
            where not (user_id is not null and age is not null and churn_date is not null
                       and city is not null and first_name is not null
                       and last_name is not null and reg_date is not null
                       and tariff is not null)
            order by user_id, tariff limit 10""",
        "tel_active_share": f"""
            select {half_up('(count(*) - count(churn_date)) / cast(count(*) as double)', 8)}
                   as share from tel_users""",
        "tel_multi_tariff_users": """
            select user_id, count(tariff) as tariff_count
            from (select distinct user_id, tariff from tel_users where churn_date is null) d
            group by user_id having count(tariff) > 1""",
        "tel_calls_null_rows": """
            select * from tel_calls where not (duration is not null and call_date is not null)""",
        "tel_call_duration_range": """
            select min(duration) as min_duration, max(duration) as max_duration from tel_calls""",
        "tel_missed_call_share": f"""
            select {half_up('count(*) filter (duration = 0) / cast(count(*) as double)', 8)}
                   as share from tel_calls""",
        "tel_top_daily_talk": f"""
            select user_id, call_date, {half_up('sum(duration) / 60', 6)} as total_day_duration
            from tel_calls group by user_id, call_date
            order by sum(duration) / 60 desc nulls first, user_id asc nulls last,
                     call_date asc nulls last limit 10""",
        "tel_monthly_minutes": "select * from call_months",
        "tel_monthly_traffic": f"""
            select user_id, dt_month, {half_up('month_mb_traffic', 4)} as month_mb_traffic
            from net_months""",
        "tel_monthly_sms": "select * from sms_months",
        "tel_activity_months": months,
        "tel_user_month_stats": stats,
        "tel_overage": over,
        "tel_month_cost": cost,
        "tel_activity_months_first5": f"{months} {order} limit 5",
        "tel_user_month_stats_first10": f"{stats} {order} limit 10",
        "tel_overage_first10": f"{over} {order}{tariff} limit 10",
        "tel_month_cost_first10": f"{cost} {order}{tariff} limit 10",
        "tel_avg_cost_by_tariff": f"""
            select tariff, count(distinct user_id) as total_users,
                   {half_up('avg(total_cost)', 2)} as avg_total_cost
            from active_cost_rows group by tariff""",
        "tel_overcost_by_tariff": f"""
            select tariff, count(distinct user_id) as total_users,
                   {half_up('avg(total_cost)', 2)} as avg_total_cost,
                   {half_up('avg(total_cost - rub_monthly_fee)', 2)} as overcost
            from active_cost_rows where total_cost > rub_monthly_fee
            group by tariff, rub_monthly_fee""",
    }


def _realty() -> dict[str, str]:
    return {
        "re_limits": "select * from edges",
        "re_filtered_ids": "select id from kept_flats",
        "re_region_label": "select * from part_rows",
        "re_exposition_segment": "select * from seg_rows",
        "re_segment_report": f"""
            select g.* exclude (balconies),
                   {half_up('100.0 * balconies / total_in_seg', 2)} as balcony_percentage,
                   {half_up('100.0 * total_in_seg / sum(total_in_seg) over (partition by city_part)', 2)}
                       as total_in_seg_per
            from (select city_part, seg, count(*) as total_in_seg,
                         {half_up('avg(last_price)', 2)} as avg_price,
                         {half_up('avg(last_price / total_area)', 2)} as avg_price_per_sqm,
                         {half_up('avg(total_area)', 2)} as avg_area,
                         {half_up('avg(rooms)', 1)} as avg_rooms,
                         count(*) filter (balcony > 0) as balconies
                  from part_rows join seg_rows using (id)
                  where seg is not null group by city_part, seg) g""",
        "re_seasonality": f"""
            select p.m as publication_month, p.n as publications_count,
                   cast(p.r as int) as publication_rank, d.n as removals_count,
                   cast(d.r as int) as removal_rank,
                   {half_up('q.per_sqm', 2)} as avg_price_per_sqm,
                   {half_up('q.area', 2)} as avg_total_area, q.n as transactions_count
            from listed_months p left join delisted_months d on d.m = p.m
            left join priced_months q on q.m = p.m""",
        "re_city_ranking": f"""
            select city, count(*) as cnt_amount,
                   {half_up('100.0 * count(days_exposition) / count(*)', 2)} as share_sold,
                   {half_up('avg(last_price / total_area)', 2)} as avg_price_per_sqm,
                   {half_up('avg(total_area)', 2)} as avg_area,
                   {half_up('avg(days_exposition)', 2)} as avg_days_publication
            from part_rows left join re_city using (city_id) left join re_ads using (id)
            where city_part = 'Ленинградская область' and id in (select id from kept_flats)
            group by city order by cnt_amount desc, city asc nulls last limit 10""",
    }


def _game() -> dict[str, str]:
    user_columns = {
        "id": "bigint", "tech_nickname": "string", "class_id": "string", "ch_id": "string",
        "birthdate": "date", "pers_gender": "string", "registration_dt": "date",
        "server": "string", "race_id": "int", "payer": "int", "loc_id": "string",
    }
    event_columns = {
        "transaction_id": "bigint", "id": "bigint", "item_code": "bigint", "amount": "double",
        "date": "date", "time": "string", "seller_id": "bigint",
    }

    def catalogue(view: str, columns: dict[str, str]) -> str:
        return _per_name(
            columns,
            lambda c: f"'{view}' as table_name, '{c}' as column_name, "
            f"'{columns[c]}' as data_type, count(distinct {c}) = count(*) as is_key",
            view,
        )

    def total(view: str) -> str:
        return f"(select count(*) from {view}) as total_rows"

    all_buyers = "cast((select count(distinct id) from real_buys) as double)"
    event_order = ", ".join(f"{c} nulls last" for c in event_columns)
    return {
        "game_payer_share": f"""
            select count(*) as total_users, count(*) filter (payer = 1) as payers,
                   {half_up('count(*) filter (payer = 1) / cast(count(*) as double)', 8)}
                       as payers_share
            from g_users""",
        "game_payer_share_by_race": f"""
            select race, count(*) filter (payer = 1) as payers_in_race,
                   count(race_id) as total_in_race,
                   {half_up('count(*) filter (payer = 1) / cast(count(race_id) as double)', 8)}
                       as payers_share
            from g_race join g_users using (race_id) group by race
            having count(*) filter (payer = 1) > 0""",
        "game_amount_stats": f"""
            select count(transaction_id) as total_count, {half_up('sum(amount)', 2)} as total_sum,
                   min(amount) as min_amount, max(amount) as max_amount,
                   {half_up('avg(amount)', 2)} as avg_amount,
                   quantile_disc(amount, 0.5) as median, {half_up('stddev_samp(amount)', 2)} as std
            from g_events""",
        "game_zero_purchases": f"""
            select count(*) filter (amount = 0) as null_amount,
                   {half_up('count(*) filter (amount = 0) / cast(count(*) as double)', 8)}
                       as null_amount_share
            from g_events""",
        "game_item_popularity": f"""
            select game_items, count(*) as absolute_count,
                   {half_up('count(*) / cast((select count(*) from real_buys) as double)', 8)}
                       as relative_count,
                   {half_up(f'count(distinct id) / {all_buyers}', 8)} as users_item_share
            from real_buys join g_items using (item_code)
            where game_items is not null group by game_items""",
        "game_race_report": f"""
            select race, total_users, total_customers, total_payers,
                   {half_up('total_customers / cast(total_users as double)', 8)} as customers_share,
                   {half_up('total_payers / cast(total_customers as double)', 8)} as payers_share,
                   total_events // total_customers as events_per_person,
                   {half_up('mean_of_means', 2)} as avg_cost_one1,
                   {half_up('mean_spent / (total_events // total_customers)', 2)} as avg_cost_one2,
                   {half_up('mean_spent', 2)} as avg_cost_all
            from race_members join race_customers using (race) join race_buyers using (race)
            join race_payers using (race)""",
        "cat_tables": " union all ".join(
            f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES
        ),
        "cat_columns_users": catalogue("g_users", user_columns),
        "cat_columns_events": catalogue("g_events", event_columns),
        "game_users_preview": f"""
            select distinct *, {total('g_users')} from g_users order by id limit 5""",
        "game_users_null_count": """
            select count(*) as row_count from g_users
            where not (loc_id is not null and class_id is not null and ch_id is not null
                       and pers_gender is not null and server is not null
                       and race_id is not null and payer is not null)""",
        "game_users_by_server": "select server, count(*) as row_count from g_users group by server",
        "game_events_preview": f"""
            select *, {total('g_events')} from g_events order by {event_order} limit 5""",
        "game_events_null_count": """
            select count(*) as row_count from g_events
            where not (date is not null and time is not null and amount is not null
                       and seller_id is not null)""",
        "game_events_null_breakdown": """
            select cast(sum(cast(date is not null as int)) as bigint) as data_count,
                   cast(sum(cast(time is not null as int)) as bigint) as data_time,
                   cast(sum(cast(amount is not null as int)) as bigint) as data_amount,
                   cast(sum(cast(seller_id is not null as int)) as bigint) as data_seller_id
            from g_events
            where not (date is not null and time is not null and amount is not null
                       and seller_id is not null)""",
    }


def _sales() -> dict[str, str]:
    loaded = f"select row_id, {_quoted_games()} from raw_games"
    top = """
            select platform, count(*) as count from period_rows
            where platform is not null group by platform
            order by count(*) desc, platform limit 7"""

    def info(names, types: dict[str, str], source: str) -> str:
        return _per_name(
            list(zip(_GAMES, names)),
            lambda pair: f"'{pair[1]}' as column_name, count({pair[0]}) as non_null, "
            f"'{types[pair[0]]}' as data_type",
            source,
        )

    styles = {
        h: "слово начинается с заглавной буквы"
        if h in ("Name", "Platform", "Genre", "Critic Score", "User Score", "Rating")
        else "смешанный стиль"
        for h in _HEADER
    }
    graded_user = _GRADE.format(c="user_score", a=3, b=8, d=10)
    graded_critic = _GRADE.format(c="critic_score", a=30, b=80, d=100)
    fold = {"name": "lower", "genre": "lower", "rating": "upper"}
    mean = "avg({c}) over (partition by platform, year_of_release)"
    imputed = {
        c: half_up(
            f"coalesce({c}, case when platform is not null then {mean.format(c=c)} end)", 6
        )
        for c in ("eu_sales", "jp_sales")
    }
    return {
        "nb_load": f"select row_number() over (order by row_id) - 1 as row_id, {_quoted_games()} from raw_games",
        "nb_preview": f"{loaded} order by row_id limit 5",
        "nb_info": info(_HEADER, _RAW_TYPES, "raw_games"),
        "nb_info_typed": info(_GAMES, _TYPED_TYPES, "typed_games"),
        "nb_name_style": _per_name(
            list(zip(_GAMES, _HEADER)),
            lambda pair: f"'{pair[1]}' as column_name, count({pair[0]}) as non_null, "
            f"'{styles[pair[1]]}' as style",
            "raw_games",
        ),
        "nb_snake_case": "select * from raw_games",
        "nb_year_fix": """
            select * replace (cast(year_of_release as int) as year_of_release)
            from raw_games where year_of_release is not null""",
        "nb_numeric_fix": "select * from typed_games",
        "nb_null_profile": _per_name(
            _GAMES,
            lambda c: f"'{c}' as column_name, count(*) - count({c}) as missing, "
            f"round_even(cast(count(*) - count({c}) as double) * 100 / count(*), 2) as missing_pct",
            "typed_games",
        ),
        "nb_score_sentinel": "select * from scored_games",
        "nb_group_mean_impute": f"""
            select * replace ({imputed['eu_sales']} as eu_sales,
                              {imputed['jp_sales']} as jp_sales)
            from scored_games""",
        "nb_label_fill": "select * from filled_games",
        "nb_cardinality": _per_name(
            fold,
            lambda c: f"'{c}' as column_name, count(distinct {c}) as distinct_raw, "
            f"count(distinct {fold[c]}({c})) as distinct_folded",
            "filled_games",
        ),
        "nb_dup_flags": f"""
            select *, row_number() over (partition by {', '.join(_GAMES)} order by row_id) > 1
                       as is_duplicate,
                   row_number() over (partition by name, platform, year_of_release
                                      order by row_id) > 1 as is_key_duplicate
            from filled_games""",
        "nb_distinct_values": " union ".join(
            f"select '{c}' as column_name, cast({c} as varchar) as value from filled_games"
            for c in ("platform", "year_of_release", "genre", "rating")
        ),
        "nb_dedup": "select * from unique_games",
        "nb_case_fold": "select * from folded_games",
        "nb_case_fold_counts": _per_name(
            ("genre", "rating"),
            lambda c: f"'{c}' as column_name, count(distinct {c}) as distinct_values",
            "folded_games",
        ),
        "nb_removed_rows": f"""
            select loaded - kept as removed,
                   round_even(cast(loaded - kept as double) * 100 / kept, 2) as removed_pct
            from (select (select count(*) from raw_games) as loaded,
                         (select count(*) from unique_games) as kept) c""",
        "nb_period": "select * from period_rows",
        "nb_user_category": f"select *, {graded_user} as user_category from period_rows",
        "nb_critic_category": f"select *, {graded_critic} as critic_category from period_rows",
        "nb_top_platforms": top,
        "nb_file_to_top_platforms": top,
    }


# Columns by table, and which hold whole numbers (w) or texts (t), for the searches over the driver's tables.
_SEARCHED = {
    "region": "r_regionkey:w r_name:t",
    "nation": "n_nationkey:w n_name:t n_regionkey:w",
    "customer": "c_custkey:w c_name:t c_nationkey:w c_mktsegment:t",
    "supplier": "s_suppkey:w s_name:t s_nationkey:w",
    "part": "p_partkey:w p_name:t p_brand:t p_type:t p_size:w",
    "orders": "o_orderkey:w o_custkey:w o_orderstatus:t o_orderpriority:t",
    "lineitem": "l_orderkey:w l_partkey:w l_suppkey:w l_linenumber:w l_returnflag:t l_linestatus:t",
}
_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def _catalogue() -> dict[str, str]:
    sets = [s for n in (1, 2) for s in combinations(_LINE_COLUMNS, n)]
    unique = " union all ".join(
        f"select {list(s)} as cols where (select count(*) = count(distinct ({', '.join(s)}, 0)) from lineitem "
        f"where {' and '.join(f'{c} is not null' for c in s)}) "
        f"and not exists (select 1 from lineitem where {' or '.join(f'{c} is null' for c in s)})"
        for s in sets
    )
    held = [(t, *c.split(":")) for t, columns in _SEARCHED.items() for c in columns.split()]
    key = "(select count({c}) = count(*) and count(distinct {c}) = count(*) from {t})"
    within = " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, '{kt}' as key_table, '{kc}' as key_column, "
        f"{str(c.split('_', 1)[1] == kc.split('_', 1)[1]).lower()} as same_name "
        f"where {key.format(c=kc, t=kt)} and exists (select 1 from {t} where {c} is not null) "
        f"and not exists (select {c} from {t} where {c} is not null except select {kc} from {kt})"
        for t, c, kind in held
        for kt, kc, other in held
        if kind == other and (t, c) != (kt, kc)
    )
    return {
        "cat_keys_lineitem": f"""
            with found as ({unique})
            select 'lineitem' as table_name, array_to_string(cols, ',') as key_columns from found a
            where not exists (select 1 from found b where len(b.cols) < len(a.cols) and list_has_all(a.cols, b.cols))""",
        "cat_references": within,
    }


def oracle_sql(views: Mapping[str, str] = VIEW_SQL) -> dict[str, str]:
    """SQL by key; with no ``views`` it reads tables of the views' names."""
    bodies = {**_telecom(), **_realty(), **_game(), **_sales(), **_catalogue()}
    return {key: with_steps(sql, views) for key, sql in bodies.items()}
