"""Benchmark: headline catalog queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS].  Each query runs four times through the ``noop`` sink
(the whole plan executes, nothing is collected); the first run warms up and
the fastest of the three warm runs is recorded (the host's timing noise is
large next to these sub-second queries).  Prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from marketlens.plans.catalog import entries  # noqa: E402
from marketlens.session import build_session  # noqa: E402

HEADLINE = (
    "t4_period_gainers",          # Q5 flagship
    "t4_period_gainers_brand",
    "t5_high_volume",             # Q6
    "p1_process_bars",            # Q1 steps
    "p1_process_brand_bars",
    "u1_dedupe_first",
    "a1_symbol_profile",
    "a5_market_summary",
    "w1_indicators_brand",        # W1-W8 on long histories
    "w9_anomalies_brand",
    "w13_signals_brand",
    "q2_analysis_pipeline",       # Q2
    "q3_insights_flat",           # Q3
    "t3_anomaly_list_brand",
    "u3_missing_days_brand",
    "j8_symbol_detail",           # Q7
    "w22_recent_changes",
    "a8_collection_report",       # Q8
    "r1_band_alerts",
    "r5_sustained_high",
    "r7_counter_rate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    spark = build_session(f"local[{cpus}]", app="marketlens-bench",
                          shuffle_partitions=max(8, 2 * cpus))
    cat = entries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = cat[name].fn
        runs = []
        for _ in range(4):
            t = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        times[name] = round(min(runs[1:]), 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
