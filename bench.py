"""Wall time of the headline queries: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma
separated, default the list below). Results are consumed in full by a sink that writes nothing.
"""

from __future__ import annotations

import json
import os
import time

from kpiweave.plans.catalog import queries
from kpiweave.session import build_session

HEADLINE = [
    "normalize_daily", "normalize_weekly", "corrections_daily", "corrections_weekly", "upsert_daily",
    "upsert_weekly", "multimarket_split", "fold_deliveries", "fold_corrections", "fold_deliveries_weekly",
    "fold_corrections_weekly", "weekly_averages", "monthly_averages", "weekly_averages_merged",
    "registry_flags", "calendar_day", "matrix_daily", "matrix_weekly", "matrix_monthly", "facts",
    "report_status", "expected_vs_delivered", "reprocess_plan",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    known = queries()
    consume(known["scan_daily_feed"](spark, sf_dir))  # the first query pays for starting up
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        consume(known[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
