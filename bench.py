"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then three timed runs; the median is
reported. A run executes the full plan into the no-op sink (nothing is
collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candlewick.plans import catalog  # noqa: E402
from candlewick.session import get_spark  # noqa: E402

HEADLINE = [
    "trend_report", "feature_mart", "anomaly_baseline", "anomaly_alerts", "ma_cross_events", "macd",
    "rsi_strict", "roc_lag_features", "correlation_matrix", "market_stats_latest", "contract_valid",
    "dedupe_latest", "recent_n_per_key", "call_event_join", "describe", "ingest_backfill", "candles_from_landing",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", "candlewick-bench", shuffle_partitions=max(cpus, 8),
                      extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    out: dict[str, float] = {}
    for name in names:
        fn = qs[name]

        def once():
            spark.catalog.clearCache()          # every timed run computes from the tables
            t = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t

        once()
        out[name] = round(statistics.median(once() for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
