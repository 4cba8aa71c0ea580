"""Times the headline analyses and prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores,
``BENCH_RUNS`` the timed runs per query after one warm-up (median reported).
Each run builds the DataFrame anew and writes every row to a discarding sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyroom.registry import queries  # noqa: E402
from tallyroom.session import build_session  # noqa: E402

HEADLINE = (
    "tel_avg_cost_by_tariff", "tel_overcost_by_tariff", "tel_user_month_stats",
    "tel_activity_months", "tel_month_cost", "tel_top_daily_talk", "tel_multi_tariff_users",
    "re_limits", "re_segment_report", "re_seasonality", "re_city_ranking",
    "game_payer_share_by_race", "game_amount_stats", "game_item_popularity", "game_race_report",
    "cat_columns_events", "game_events_null_breakdown",
    "nb_load", "nb_null_profile", "nb_group_mean_impute", "nb_dup_flags", "nb_case_fold",
    "nb_removed_rows", "nb_user_category", "nb_top_platforms",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()

    def timed(key: str) -> float:
        start = time.perf_counter()
        known[key](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for key in HEADLINE:
        timed(key)
        seconds[key] = round(statistics.median(timed(key) for _ in range(runs)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[1]) if scale else None,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
