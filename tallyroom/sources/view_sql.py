"""Domain views over the driver's tables, as SQL both Spark and DuckDB run.

The driver's tables hold no NULLs, ties or dirty text, so the views plant them
by value. Every row of the tables takes part: nothing is left out by id.

Two spellings differ between the engines and are written as tokens:
``COPIES(n)`` makes one row per number 0..n, ``DAYS(a, b)`` is b - a in days.
"""

from __future__ import annotations

import re

VIEW_SQL: dict[str, str] = {
    # 30 of 1500 users hold both tariffs; negative balances have churned.
    "tel_users": """
        select c_custkey as user_id, cast(18 + c_custkey % 60 as int) as age,
               case when c_acctbal < 0 then cast('2001-01-01' as date) end as churn_date,
               n_name as city, c_name as first_name,
               case when c_custkey % 97 = 0 then null else c_mktsegment end as last_name,
               cast('1995-01-01' as date) as reg_date,
               case when copy = 0 then tariff when tariff = 'ultra' then 'smart' else 'ultra' end
                   as tariff
        from (select c.*,
                     case when c_mktsegment in ('AUTOMOBILE', 'BUILDING')
                          then 'ultra' else 'smart' end as tariff,
                     COPIES(case when c_custkey % 50 = 0 then 1 else 0 end) as copy
              from customer c) held
        join nation on c_nationkey = n_nationkey""",
    "tel_tariffs": """
        select 'smart' as tariff_name, 20 as minutes_included, 10240 as mb_per_month_included,
               1 as messages_included, 550 as rub_monthly_fee, 3 as rub_per_minute,
               200 as rub_per_gb, 3 as rub_per_message
        union all select 'ultra', 60, 30720, 2, 1950, 1, 150, 1""",
    # Lines split by return flag into calls and internet sessions.
    "tel_calls": """
        select o_custkey as user_id,
               case when l_linenumber = 5 and l_quantity = 49 then null
                    else cast(l_shipdate as date) end as call_date,
               case when l_linenumber = 7 then 0.0e0
                    when l_linenumber = 6 and l_quantity < 5 then null
                    else l_quantity end as duration
        from lineitem join orders on l_orderkey = o_orderkey
        where l_returnflag <> 'R'""",
    "tel_internet": """
        select o_custkey as user_id, cast(l_shipdate as date) as session_date,
               l_quantity * 512 as mb_used
        from lineitem join orders on l_orderkey = o_orderkey
        where l_returnflag = 'R'""",
    "tel_messages": """
        select o_custkey as user_id, cast(o_orderdate as date) as message_date from orders""",
    # Lines are summed per order before the join, so no order's lines meet in one task.
    "re_flats": """
        select o_orderkey as id, c_nationkey as city_id, total_area,
               cast(coalesce(lines, 0) as int) as rooms, balcony, ceiling_height
        from orders join customer on o_custkey = c_custkey
        left join (select l_orderkey, count(*) as lines, max(l_quantity) as total_area,
                          nullif(min(l_linenumber) - 1, 0) as balcony,
                          max(case when l_tax > 0.0 then l_tax end) as ceiling_height
                   from lineitem group by l_orderkey) x on l_orderkey = o_orderkey""",
    "re_city": """
        select n_nationkey as city_id,
               case when n_nationkey = 0 then 'Санкт-Петербург' else n_name end as city
        from nation""",
    # Pending low-priority orders are flats without an advertisement.
    "re_ads": """
        select id, first_day_exposition,
               case when d between 0 and 720 then cast(d as int) end as days_exposition,
               last_price
        from (select o_orderkey as id, cast(o_orderdate as date) as first_day_exposition,
                     o_totalprice as last_price,
                     DAYS(cast(o_orderdate as date), cast(last_ship as date)) as d
              from orders
              left join (select l_orderkey, max(l_shipdate) as last_ship
                         from lineitem group by l_orderkey) x on l_orderkey = o_orderkey
              where not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')) y""",
    "g_users": """
        select c_custkey as id, c_name as tech_nickname,
               case when c_nationkey = 7 then null else concat('class_', c_mktsegment) end
                   as class_id,
               concat('ch_', cast(c_nationkey as varchar(10))) as ch_id,
               cast('1990-01-01' as date) as birthdate,
               case when c_acctbal > 5000 then 'F' else 'M' end as pers_gender,
               cast('2020-01-01' as date) as registration_dt,
               case when c_custkey % 31 = 0 then null else c_mktsegment end as server,
               n_regionkey as race_id, case when c_acctbal > 7500 then 1 else 0 end as payer,
               concat('loc_', n_name) as loc_id
        from customer join nation on c_nationkey = n_nationkey""",
    "g_race": "select r_regionkey as race_id, r_name as race from region",
    # Parts of the largest size are missing from the catalogue.
    "g_items": """
        select p_partkey as item_code, p_name as game_items from part where p_size <> 50""",
    # A third of the players only ever record free (zero) purchases.
    "g_events": """
        select l_orderkey * 10 + l_linenumber as transaction_id, o_custkey as id,
               l_partkey as item_code,
               case when o_custkey % 3 = 0 or l_quantity = 1 then 0.0e0
                    when l_quantity = 2 then null
                    else l_extendedprice end as amount,
               case when l_linenumber = 7 then null else cast(l_shipdate as date) end as date,
               case when l_discount = 0.0 then null
                    else concat(cast(10 + l_linenumber as varchar(4)), ':00:00') end as time,
               case when l_linenumber = 6 then null else l_suppkey end as seller_id
        from lineitem join orders on l_orderkey = o_orderkey""",
    # One part in fifty is listed twice; row_id is the position in the file.
    "raw_games": """
        select p_partkey * 2 + copy as row_id,
               case when p_partkey % 400 = 399 then null else p_name end as name,
               p_brand as platform,
               case when p_partkey % 60 = 59 then null
                    else cast(1994 + p_size % 23 as double) end as year_of_release,
               case when p_partkey % 500 = 499 then null
                    when p_partkey % 37 = 0 then upper(replace(p_type, 'SMALL', 'ROLE-PLAYING'))
                    else lower(replace(p_type, 'SMALL', 'ROLE-PLAYING')) end as genre,
               cast(p_size as double) / 10 as na_sales,
               case when p_partkey % 41 = 0 then 'unknown'
                    else replace(cast(cast(p_size % 17 as decimal(4, 2)) as varchar(10)), '.', ',')
               end as eu_sales,
               case when p_partkey % 43 = 0 then null
                    else replace(cast(cast(p_size % 13 as decimal(4, 2)) as varchar(10)), '.', ',')
               end as jp_sales,
               cast(p_size % 7 as double) / 10 as other_sales,
               case when p_partkey % 2 = 0 then null
                    else cast(p_size * 2 as double) end as critic_score,
               case when p_partkey % 3 = 0 then null when p_partkey % 7 = 0 then 'tbd'
                    else concat(cast(cast(floor(p_retailprice / 10) as int) % 10 as varchar(4)),
                                ',',
                                cast(cast(floor(p_retailprice) as int) % 10 as varchar(4)))
               end as user_score,
               case when p_partkey % 5 < 2 then null when p_partkey % 5 = 2 then 'e'
                    when p_partkey % 5 = 3 then 'E' else 'T' end as rating
        from (select p.*, COPIES(case when p_partkey % 50 = 7 then 1 else 0 end) as copy
              from part p) listed""",
}


def in_spark(sql: str) -> str:
    sql = re.sub(r"COPIES\((.*?) end\)", r"explode(sequence(0, \1 end))", sql)
    return re.sub(r"DAYS\((.*?\)), (.*?\))\)", r"datediff(\2, \1)", sql)


def in_duckdb(sql: str) -> str:
    sql = re.sub(r"COPIES\((.*?) end\)", r"unnest(generate_series(0, \1 end))", sql)
    return re.sub(r"DAYS\((.*?\)), (.*?\))\)", r"date_diff('day', \1, \2)", sql)
