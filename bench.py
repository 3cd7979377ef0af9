"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Seconds per query are the median of $BENCH_RUNS runs after a warm-up, reading of the input included; results go to
Spark's noop sink, so that every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from loomframe.catalog import all_queries
from loomframe.operators import scale as C
from loomframe.session import local_session

HEADLINE = [
    "c1_standard_scale", "c3_robust_scale", "e4_target_encode", "e6_woe_encode", "w1_rolling_zscore",
    "w3_seasonal_additive_even", "m6_interpolate_linear", "t4_tfidf", "n1_knn_join", "o3_local_outlier_factor",
    "r1_least_squares", "r9_gaussian_nb_score", "r14_best_split_gini", "v4_grid_search", "a11_roc_curve",
    "a12_precision_recall_curve", "a14_roc_auc", "d2_stratified_split", "g3_avg_clustering", "c3_approximate",
]


def c3_approximate(spark, sf):
    cols = ["l_quantity", "l_discount", "l_tax"]
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select(*cols)
    return C.robust_scale(df, cols, approximate=True).transform(df)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    queries = {**all_queries(), "c3_approximate": c3_approximate}
    spark = local_session("bench")
    seconds = {}
    for name in names:
        taken = []
        for i in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i or runs == 0:
                taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
