"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line with per-query seconds (execution forced with the ``noop``
sink, so no rows are collected to the driver).

Each query runs twice in one session: ``queries_cold`` is the first run (JVM
and Python workers warming up, cold file cache), ``queries`` the second. No
DataFrame is cached between runs; both read the Parquet files from scratch.
``value`` is the sum of the warm runs."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txrisk.plans.catalog import QUERIES  # noqa: E402
from txrisk.session import build_session  # noqa: E402

HEADLINE = [
    "rolling_user_1d_7d", "rolling_multi_key", "rolling_ties_orders", "time_features",
    "encode_categories", "null_profile", "daily_stats", "describe_by_class", "box_stats",
    "top_values", "batch_manifest_7d", "roc_auc", "average_precision", "threshold_sweep",
    "evaluate_labels", "undersample", "oversample", "knn5", "smote", "drift_first_detection",
    "feature_store_roundtrip", "stream_prequential_rule",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="txrisk-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    cold, warm, errors = {}, {}, {}
    for name in names:
        try:
            for r in range(max(1, runs)):
                t0 = time.time()
                df = QUERIES[name](spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
                dt = round(time.time() - t0, 3)
                (cold if r == 0 else warm)[name] = dt
            warm.setdefault(name, cold[name])
            print(f"# {name}: cold {cold[name]}s warm {warm[name]}s", file=sys.stderr)
        except Exception as e:  # noqa: BLE001 - report and keep benchmarking the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
            cold.pop(name, None)
            warm.pop(name, None)
            print(f"# {name}: FAILED {errors[name]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds_warm", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "queries_cold": cold,
                      "total_cold": round(sum(cold.values()), 3), "errors": errors,
                      "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
