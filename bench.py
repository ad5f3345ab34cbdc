"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line with per-query seconds.

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from countpanel.plans.registry import load_all, runner  # noqa: E402
from countpanel.session import get_session  # noqa: E402

HEADLINE = [
    "integration_top_cities",  # scan, rollup, complete buckets, 2 joins, top-k
    "a1_rollup_hourly",  # hourly rollup
    "j1_join_weather",  # fact x hourly weather
    "a10_site_profile",  # exact medians and conditional means
    "j15_count_within",  # spatial grid join
    "w6_rolling_median",  # centred rolling median (chunked windows)
    "n2_rolling_outliers",  # gap filling + outlier layer
    "f4_panel_features",  # lags + rolling means in one sort
    "v1_verify",  # forecast verification
    "r2_site_resilience",  # rain resilience
    "i1_impact",  # impact cascade (exact decimals)
    "q4_missing_hours",  # calendar anti join
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", partitions=max(8, cpus * 2), app="countpanel-bench")
    reg = load_all()
    # warm-up: JVM class loading, codegen paths and Python workers, not timed
    for name in ("a18_value_counts", "a7_profile_two_parts", "j4_join_unique", "w4_rolling_mean"):
        runner(reg[name])(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        runner(reg[name])(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
