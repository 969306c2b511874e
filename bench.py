"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs each).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from gaugeloom.plans.queries import QUERIES
from gaugeloom.session import local_session, stages

HEADLINE = [
    "flagship_scaled_windows",
    "A13_row_counts_any_size",
    "W1_split_rows",
    "W3_split_series",
    "A2_A4_standard",
    "A3_A4_robust",
    "W5_W7_windows",
    "W5_windows_wide",
    "W5_windows_one_long_series",
    "W15_rolling_features",
    "W18_prefix_windows",
    "W20_segment_stats",
    "M9_validation_tail",
    "E1_label_encode_text",
    "E2_E3_onehot_encode",
    "P0_P21_variable_table",
    "P2_count_stats",
    "P3_numeric_stats",
    "P3b_quantiles_any_size",
    "P6_word_counts",
    "P9_pearson",
    "P10_spearman",
    "P14_histogram",
    "C5_C6_removable_columns",
    "A9_A10_regression_metrics",
    "V2_conformal",
    "J7_I3_overlay",
    "M2_decision_tree",
    "M7_linear_discriminant",
    "I1_infer",
]


def run(function, spark, folder) -> float:
    with stages(spark):
        start = time.perf_counter()
        function(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, folder)
        times[name] = round(statistics.median(run(QUERIES[name], spark, folder) for _ in range(runs)), 3)
    report = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cores,
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
