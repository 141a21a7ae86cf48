"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  After an untimed warm-up
of every query on the smallest scale, each query runs $BENCH_REPEATS times
(default 2) and the fastest run is reported: the shared host's timing noise
is large compared with these small inputs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import all_queries  # noqa: E402
from quarry.session import get_session  # noqa: E402

HEADLINE = [
    "aff_pair_rules", "aff_itemsets_l3", "aff_itemsets_fp", "aff_apply_rules",
    "sql_star_join", "sql_summary_stats", "sql_region_rating", "sql_above_user_mean",
    "nb_scores", "nb_ml", "knn", "knn_cosine", "knn_folds", "tree_fit_depth2", "tree_split_gini",
    "mov_item_cosine", "mov_recommend_items", "mov_hit_rate",
    "mov_part_pairs", "tree_clf_ml", "knn_lsh", "mov_als",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", app="quarry-bench", shuffle_partitions=2 * cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    qs = all_queries()
    keys = only or HEADLINE
    # Warm-up, not timed: every query once on the smallest scale, so JIT
    # compilation, codegen and Python worker start-up are out of the timings.
    warm_dir = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if os.path.isdir(warm_dir):
        for key in keys:
            qs[key](spark, warm_dir).write.format("noop").mode("overwrite").save()
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    times = {}
    for key in keys:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[key] = round(min(runs), 3)
        print(f"{key}: {times[key]}s (runs {[round(r, 2) for r in runs]})", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
