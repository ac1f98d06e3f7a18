"""Times the headline queries: one warm-up, then the median of BENCH_RUNS runs each.

Prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the local cores and
BENCH_QUERIES (comma separated) other queries than the default ones.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparktab.plans import catalogue  # noqa: E402
from sparktab.session import local_session, release  # noqa: E402

HEADLINE = (
    "clean_profile dup_count numeric_summary category_freq iqr_report zscore_filter range_rule_counts corr_lower "
    "group_means crosstab_pct hist_auto kde_grid box_by_group one_hot strat_split strat_folds standardise "
    "knn_predict gnb_predict confidence_hist importance phi_summary top_factors score_batch best_example"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").replace(",", " ").split() or HEADLINE
    spark = local_session(cpus, app="bench")
    seconds = {}
    for name in names:
        fn, taken = catalogue.QUERIES[name], []
        for _ in range(runs + 1):
            start = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        release(spark)
        seconds[name] = round(statistics.median(taken[1:]), 4)
        print(f"{name}: first {taken[0]:.2f} s, then {seconds[name]:.2f} s", file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 4)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
