"""Wall time per query; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the local cores. ``BENCH_QUERIES``
may hold a comma-separated choice. Every query runs in full into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

from rillhouse.plans import catalog, stream_catalog
from rillhouse.session import local_session

BATCH = [
    "interval_join_orders", "interval_join_payment", "order_wide", "payment_wide",
    "lookup_product", "log_split_counts", "base_log_messages", "new_visitor_fix",
    "unique_visit", "user_jump", "session_count", "running_total", "visitor_stats",
    "visitor_stats_10s", "product_stats", "cdc_normalize", "route_by_rules", "dim_upsert",
    "ads_rollup", "ads_cube", "ads_totals", "dirty_rate",
]
STREAM = [
    "stream_interval_join_orders", "stream_unique_visit", "stream_user_jump",
    "stream_session_count", "stream_running_total", "stream_product_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or BATCH + STREAM
    known = {**catalog.QUERIES, **stream_catalog.QUERIES}

    spark = local_session(cpus, memory="16g", app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    rows = {
        t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("events", "lineitem")
    }

    times = {}
    for name in chosen:
        begin = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    replayed = {
        name: round(rows["lineitem" if "orders" in name or "product" in name else "events"] / t)
        for name, t in times.items()
        if name.startswith("stream_")
    }
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stream_rows_per_sec": replayed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
