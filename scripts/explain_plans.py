"""Write the formatted physical plan of headline queries to docs/plans/<name>.txt
and print a one-line summary (exchanges, sorts, windows, broadcast joins, scans)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txrisk.plans.catalog import QUERIES  # noqa: E402
from txrisk.session import build_session  # noqa: E402

NAMES = ["rolling_multi_key", "encode_categories", "describe_by_class", "roc_auc",
         "threshold_sweep", "undersample", "knn5", "top_values", "daily_stats"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_dir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = build_session("local[8]", 8)
    jvm = spark.sparkContext._jvm
    for name in NAMES:
        df = QUERIES[name](spark, sf)
        text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(text)
        tree = text.split("\n\n")[0]
        count = {k: len(re.findall(k, tree)) for k in
                 ("Exchange", "Sort ", "Window", "BroadcastHashJoin", "SortMergeJoin", "Scan")}
        print(name, count)
    spark.stop()


if __name__ == "__main__":
    main()
