"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Every query is executed completely (noop sink), after one warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_ranking",          # flagship: scale, encode, score, vote, rank
    "regression_report",        # Q1-Q11 in one pass
    "scorer_binary",            # Q12-Q20
    "roc_auc_ovr",              # Q21
    "describe_groups",          # G1
    "compare_variants",         # G5-G8
    "shapiro_wilk",             # G3
    "histogram",                # E3
    "box_stats",                # E2
    "interpolate_global",       # P1 over a global order
    "scale_robust",             # P8
    "scale_power",              # P9
    "preprocessor",             # P17
    "stratified_kfold",         # M2
    "select_best_features",     # V12
    "score_chi2_contingency_classification",  # F4b
    "relief_weights",           # F14
    "forest_predict_soft",      # T6 + T9
    "svr_fit_predict",          # R4 + R6
    "shapley_linear",           # X1
    "knn_graph",                # E7
    "cv_results",               # M8
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    from quarry.catalog import QUERIES, load_all
    from quarry.session import get_spark
    load_all()
    spark = get_spark()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["accuracy"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
