"""Headline timings: one JSON line with seconds per query, results fully computed.

Each query runs once to warm up and once for the record.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from accesslens.plans import catalog  # noqa: E402

HEADLINE = [
    "stats", "recent", "record_search", "user_detail", "timeline", "top_reject", "risk_accounts",
    "multi_mac_summary", "multi_mac_detail", "reason_distribution", "nas_distribution",
    "ingest_status", "acct_dashboard_stats", "acct_dashboard_sessions", "acct_history",
    "rollup_stat_10m", "rollup_user_10m", "rollup_user_mac_10m", "rollup_auth_wide_10m",
    "user_summary", "acct_rollup_1h_exact", "dedup_events", "sample_interim", "accounting_deltas",
    "event_spans", "terminal_path", "extract_udp", "decode_accounting", "pair_auth",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("accesslens-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = catalog.queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
