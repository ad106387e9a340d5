"""Headline queries, timed: one JSON line with the median of three warm runs each."""

from __future__ import annotations

import json
import os
import statistics
import time

from sensorlake.catalog import QUERIES
from sensorlake.session import build_session

HEADLINE = (
    "e01_window_analytics", "e10_iqr_outliers", "h01_rolling_zscore", "m04_severity_ladder",
    "h08_sustained_alert", "e14_correlation", "c11_sanitize", "c08_validation", "h03_rolling_rates",
    "h04_rolling_means", "m06_all_alerts", "e21_binary_metrics", "e05_numeric_profile",
    "k07_retention_plan",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", 8, spark__ui__enabled="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "spark": spark.version, "readings": rows,
        "readings_per_second": {n: round(rows / s) for n, s in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
