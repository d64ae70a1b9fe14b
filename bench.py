"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed completely with the ``noop`` sink (no collect to the driver); the time
per query is the median of ``$BENCH_REPEATS`` runs (default 3) after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "b01_offer_features",
    "d05_kpi_summary_vertical",
    "d06_kpi_summary_2d",
    "d24_pareto_vertical",
    "d29_kaplan_meier",
    "f14_device_features",
    "g02_temporal_split",
    "i09_ranking_metrics",
    "k05_threshold_cost_or_budget",
    "j01_match_alerts_failures",
    "e02_correlation_matrix",
    "e17_drift_ks",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from faultline.registry import load_all
    from faultline.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    reg = load_all()
    times = {}
    for name in HEADLINE:
        fn = reg[name].fn

        def run():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        run()  # warm-up (JIT, file listing, checkpoint of reused fixtures)
        times[name] = round(statistics.median([run() for _ in range(repeats)]), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": int(cpus), "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
