"""Time the check queries: one JSON line, median seconds per query.

Every query runs to the end into a sink that drops the rows, so that neither
collecting nor writing is timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from turnstile.checks import QUERIES
from turnstile.session import build_session, shared_folder

# One headline query per group of operators.
HEADLINE = (
    "attribution_same_instant",
    "attribution_cube_week",
    "interval_join_left",
    "check_rollup",
    "budget_cube_levels",
    "revenue_with_total",
    "receipt_revenue_with_total",
    "wow_change",
    "report_text",
    "dim_join_weekly",
    "spine_left_join",
    "rolling_roas",
    "rank_label",
    "latest_version",
    "daily_answer_pivot",
    "unpivot_budget",
    "explode_lines",
    "ingest_summary",
    "sha_keys",
    "key_uniqueness",
    "upsert_orders",
    "insert_if_absent_orders",
    "stream_ingest",
    "status_net_amount",
    "parse_dates",
    "weekly_mart",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
