"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; print one JSON line."""

from __future__ import annotations

import json
import os
import time

from gridspark.plans import PLANS
from gridspark.session import local_session

HEADLINE = [
    "area_supply_halfhour", "area_supply_parse", "wide_areas", "spot_price_parse", "bid_stack", "bid_stack_first",
    "unit_generation_matrix", "weather_parse", "insert_ignore", "upsert_full", "upsert_column", "watermark_append",
    "coverage_gaps", "surrogate_id", "batch_profile", "duplicate_report", "rejects", "na_directory_scan",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "gridspark-bench")
    timings: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            PLANS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds_headline_queries", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
