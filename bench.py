"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` with a warm session and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Every query is fully executed through the ``noop`` sink (no collect to the
driver); the reported time per query is the median of ``$BENCH_REPS`` (2) runs
after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "J02_flights_origin_dest_weather",   # clean -> aggregate -> two left joins
    "J03_anti_join_holdout",             # repeatable sample + anti join
    "A06_summary_by_binned_factor",      # grouping sets summary
    "A07_cube_two_binned_factors",       # cube with full cell grid
    "A08_histogram_by_panel",            # histogram with data bounds
    "A11_exact_percentiles",             # distributed exact quantiles
    "A17_grouping_sets_hierarchy",       # hierarchy aggregation
    "H09_exact_training_rows",           # exact fractions via distributed rank
    "W02_E06_E07_bucketed_auc",          # bucketed ROC/AUC
    "P06_data_step_keep_and_compute",    # haversine feature step
    "J05_calendar_panel_fill",           # dense monthly panel
    "T10_rolling_origin_naive_rmse",     # rolling-origin evaluation
    "T12_parameter_search_scores",       # grid of settings in one plan
    "T11_T13_optimise_settings",         # the same with smoothing: the reconciliation systems are solved
    "M03_char_ngram_features",           # text features
    "E13_U06_parallel_set_scoring",      # model scoring over row sets
    "M07_S04_P03_csv_to_glm_pipeline",   # CSV -> frame -> binomial GLM (the baseline's pipeline)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "2"))
    from loam.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="loam-bench", shuffle_partitions=int(cpus) * 2,
                      extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    from loam.suite import QUERIES
    names = [q for q in HEADLINE if q in QUERIES]
    times: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]

        def run():
            t = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t
        try:
            run()  # warm-up
            times[name] = round(statistics.median(run() for _ in range(reps)), 3)
        except Exception as e:  # noqa: BLE001 - report and continue
            print(f"# {name} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
