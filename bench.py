"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Every query runs once to warm up and
then BENCH_RUNS times; its time is the median. Batch results go to the no-op sink, so the whole
result is computed and nothing is pulled to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from clickweave.catalog import QUERIES
from clickweave.session import create_session, delete_scratch

HEADLINE = [
    "decode_json_messages",
    "validate_invalid",
    "dedup_events",
    "bronze_table",
    "silver_table",
    "funnel_tumbling",
    "funnel_sliding",
    "product_performance",
    "traffic_analytics",
    "live_metrics",
    "top_categories",
    "geography",
    "traffic_sources",
    "device_breakdown",
    "funnel_latest",
    "traffic_timeseries",
    "top_products",
    "lake_summary",
    "trend",
    "funnel_stages",
    "revenue_share",
    "session_rollup",
    "session_flags",
    "running_cart",
    "transition_matrix",
    "gap_sessions",
    "stream_funnel",
    "stream_dedup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = create_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        times = 1 if name.startswith("stream_") else runs
        seconds[name] = round(statistics.median(once(name) for _ in range(times)), 3)
        delete_scratch(spark)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, median of warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "events": rows,
                "stream_events_per_sec": round(rows / seconds["stream_dedup"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
