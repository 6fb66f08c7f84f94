"""Headline timings as one JSON line; see BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import all_queries  # noqa: E402
from retourlens.session import build_session  # noqa: E402

HEADLINES = [
    "ce_user", "latest_order", "ordered_item_recently", "item_type", "size_normalised",
    "feature_table", "feature_table_hot_groups", "stratified_folds", "roc_curve", "auc_by_model",
    "mean_ensemble", "greedy_ensemble", "revenue_sweep", "calibration", "cost_summary",
    "decide_unknown",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"), spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    # Start the JVM's code generation before the clock runs.
    registered["cost_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(sf_dir).removeprefix("sf")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
