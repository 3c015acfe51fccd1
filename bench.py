"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1). BENCH_CPUS: local threads (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskloom.plans.queries import QUERIES  # noqa: E402
from riskloom.session import build_session  # noqa: E402

HEADLINE = [
    "clean_table", "missingness", "duplicate_conflicts", "unique_keys", "fraud_by_dimension", "behavior_features",
    "velocity_audit", "network_features", "device_summary", "device_card_edges", "model_base", "rule_decisions",
    "system_comparison", "threshold_sweep", "roc_auc", "threshold_economics", "review_capacity", "daily_monitoring",
    "psi_numeric", "psi_categorical", "top_drivers", "customer_history", "case_lookup", "linked_cards",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    QUERIES["fraud_overall"](spark, folder).collect()  # start-up of the session, not of a query
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
