"""Time the headline queries, the median of three runs each; print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verification.check import local_session  # noqa: E402
from verification.registry import queries  # noqa: E402

HEADLINES = (
    "deduped_contracts",
    "split_contracts",
    "mrr_start_new",
    "mrr_waterfall_by_tier",
    "combined_metrics",
    "combined_metrics_repriced",
    "arpu_month",
    "cumulative_arpu_summary",
    "cleaned_contracts",
    "segment_forecast",
)
# The median of so many runs counts.
RUNS = 3
# Run once on the smallest tables, so that timings show queries and not class loading.
WARM_UP = ("combined_metrics_repriced", "cumulative_arpu_summary", "segment_forecast")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores)
    registered = queries()
    small = os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001")
    for name in WARM_UP:
        run(registered[name](spark, small if os.path.isdir(small) else sf_dir))
    seconds, before_write = {}, {}
    for name in HEADLINES:
        whole, first = [], []
        for _ in range(RUNS):
            started = time.perf_counter()
            df = registered[name](spark, sf_dir)
            df._jdf.queryExecution().executedPlan()
            first.append(time.perf_counter() - started)
            run(df)
            whole.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(whole), 3)
        before_write[name] = round(statistics.median(first), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                # of these seconds: building and planning, and steps that are written on the way
                "planning_and_staging": before_write,
                "runs": RUNS,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
