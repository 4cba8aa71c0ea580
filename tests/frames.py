"""Small random tables with NULLs, repeated keys and one hot key per table.

About a third of the rows of each table share one key.
"""

from __future__ import annotations

import datetime
import random
from types import SimpleNamespace

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

SCHEMAS = {
    "tel_users": "user_id bigint, age int, churn_date date, city string, first_name string, "
    "last_name string, reg_date date, tariff string",
    "tel_tariffs": "tariff_name string, minutes_included int, mb_per_month_included int, "
    "messages_included int, rub_monthly_fee int, rub_per_minute int, rub_per_gb int, "
    "rub_per_message int",
    "tel_calls": "user_id bigint, call_date date, duration double",
    "tel_internet": "user_id bigint, session_date date, mb_used double",
    "tel_messages": "user_id bigint, message_date date",
    "re_flats": "id bigint, city_id int, total_area double, rooms int, balcony int, "
    "ceiling_height double",
    "re_city": "city_id int, city string",
    "re_ads": "id bigint, first_day_exposition date, days_exposition int, last_price double",
    "g_users": "id bigint, tech_nickname string, class_id string, ch_id string, birthdate date, "
    "pers_gender string, registration_dt date, server string, race_id int, payer int, "
    "loc_id string",
    "g_race": "race_id int, race string",
    "g_items": "item_code bigint, game_items string",
    "g_events": "transaction_id bigint, id bigint, item_code bigint, amount double, date date, "
    "time string, seller_id bigint",
    "raw_games": "row_id bigint, name string, platform string, year_of_release double, "
    "genre string, na_sales double, eu_sales string, jp_sales string, other_sales double, "
    "critic_score double, user_score string, rating string",
}

_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "date": pa.date32(),
}


def _day(rng: random.Random) -> datetime.date:
    return datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randrange(150))


def random_tables(seed: int, n: int = 300) -> dict[str, list[tuple]]:
    rng = random.Random(seed)

    def maybe(value, share=0.1):
        return None if rng.random() < share else value

    def key(size: int):
        """A third of all rows get key 1."""
        return 1 if rng.random() < 1 / 3 else rng.randrange(1, size)

    tariffs = ["smart", "ultra", "gone"]
    day = datetime.date(2021, 5, 5)
    flats = [
        (i, maybe(key(6)), maybe(float(rng.randrange(20, 60)), 0.05), maybe(rng.randrange(1, 6)),
         maybe(rng.randrange(0, 4), 0.4), maybe(rng.choice([2.5, 2.6, 2.7, 3.0]), 0.3))
        for i in range(n)
    ]
    games = [
        (maybe(f"game {key(5)}"), maybe(f"P{key(9)}", 0.05),
         maybe(float(rng.randrange(1998, 2016))),
         maybe(rng.choice(["role-playing", "Role-Playing", "NS", "o'neil", "гонки"])),
         rng.randrange(4) / 10, rng.choice(["1,5", "tbd", "2.25", " 3 ", "1d", "1e1", "nan"]),
         maybe(rng.choice(["0,5", "x", ".5"]), 0.3), 0.0,
         maybe(rng.choice([-1.0, 0.0, 29.0, 30.0, 79.0, 80.0, 100.0, 101.0])),
         maybe(rng.choice(["0", "2,9", "3", "7.9", "8", "10", "10,1", "tbd"])),
         maybe(rng.choice(["e", "E", "T", "m"])))
        for _ in range(n // 3)
    ]
    games = [rng.choice(games[:3]) if rng.random() < 1 / 3 else rng.choice(games) for _ in range(n)]
    return {
        "tel_users": [
            (maybe(key(25), 0.05), 30, maybe(day, 0.7), "c", "f", maybe("l"), day,
             maybe(rng.choice(tariffs)))
            for _ in range(30)
        ],
        "tel_tariffs": [
            ("smart", 20, 900, 1, 550, 3, 200, 3), ("ultra", 60, 3000, 2, 1950, 1, 150, 1)
        ],
        "tel_calls": [
            (maybe(key(25), 0.05), maybe(_day(rng)), maybe(rng.randrange(0, 40) / 4))
            for _ in range(n)
        ],
        "tel_internet": [
            (maybe(key(25), 0.05), maybe(_day(rng)), maybe(rng.randrange(0, 2000) / 2))
            for _ in range(n)
        ],
        "tel_messages": [(maybe(key(25), 0.05), maybe(_day(rng))) for _ in range(n)],
        "re_flats": flats,
        "re_city": [(1, "Мурино"), (2, "Санкт-Петербург"), (3, "Мурино"), (4, None)],
        "re_ads": [
            (i, maybe(_day(rng)),
             maybe(rng.choice([0, 1, 30, 31, 90, 91, 180, 181, 400]), 0.3),
             maybe(float(rng.randrange(1000, 9000))))
            for i in range(0, n + 20) if rng.random() < 0.9
        ],
        "g_users": [
            (i, f"n{i}", maybe("a"), maybe("b"), day, maybe("F"), day, maybe(f"s{key(4)}"),
             maybe(key(5)), maybe(rng.randrange(2)), maybe("l"))
            for i in range(60)
        ],
        "g_race": [(1, "elf"), (2, "orc"), (3, "elf"), (4, "hobbit"), (9, "nobody")],
        "g_items": [(i, maybe(f"item {i % 5}")) for i in range(20)] + [(1, "item 1 again")],
        "g_events": [
            (i // 2, maybe(key(70)), maybe(key(25)),
             maybe(rng.choice([0.0, 0.0, 1.5, 2.25, 7.0, 100.0])), maybe(_day(rng)),
             maybe("10:00"), maybe(rng.randrange(5)))
            for i in range(n)
        ],
        "raw_games": [(i, *row) for i, row in enumerate(games)],
    }


def fields(name: str) -> list[tuple[str, str]]:
    return [tuple(f.split(" ")) for f in SCHEMAS[name].split(", ")]


def in_spark(spark: SparkSession, tables: dict[str, list[tuple]]) -> SimpleNamespace:
    return SimpleNamespace(
        **{name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in tables.items()}
    )


def in_duckdb(tables: dict[str, list[tuple]]) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name, rows in tables.items():
        columns = list(zip(*rows)) if rows else [[] for _ in fields(name)]
        arrow = pa.table(
            {f: pa.array(list(c), _ARROW[t]) for (f, t), c in zip(fields(name), columns)}
        )
        con.register("incoming", arrow)
        con.execute(f'create table {name} as select * from incoming')
        con.unregister("incoming")
    return con
