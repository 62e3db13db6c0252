"""Benchmark: run the headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``
and print ONE JSON line with per-query seconds.

Each query is executed in full with the ``noop`` sink (every row computed, nothing
collected to the driver). Before timing, every headline query runs once on the
smallest data set (``$BENCH_WARMUP_DIR``, default the sibling ``sf0.001`` folder) so
JVM start-up, JIT and code generation are not charged to the measured run; nothing is
cached between the warm-up and the measured data.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "standard_daily",
    "yield_group_day",
    "animal_month_yield",
    "yield_group_month",
    "per_cow_yield",
    "monthly_weights",
    "dim_weights_merged",
    "cow_month_weight",
    "weight_group",
    "filtered_feed",
    "weight_difference_ing",
    "error_by_weight_pen",
    "nutrient_delivery",
    "nutrient_error",
    "nutrient_error_pen",
    "session_yield",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from herdfeed.plans.registry import RAW_QUERIES
    from herdfeed.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="herdfeed-bench")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:
        RAW_QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        RAW_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
