"""Time the headline queries on one scale of the test tables and print one JSON line.

Each query runs once to warm up and once for the time; its whole result is computed and dropped.
"""

from __future__ import annotations

import json
import os
import time

from windvane.plans import catalog
from windvane.session import session

HEADLINE = [
    "daily_features", "n1_backfill", "n2_interpolate_linear", "j1_join_outer_keys", "j5_join_asof_backward",
    "j6_join_asof_nearest", "j7_join_horizon", "j9_grid_left_join", "a1_group_by_period", "a9_correlation_matrix",
    "a14_box_stats", "f9_bin_quantile", "w3_add_features", "w4_rolling_sum_global", "w8_sliding_sequences",
    "w9_row_position", "l2_ttf_days", "l5_horizon_flags_per_component", "o7_split_by_months", "c1_standard_scale",
    "c2_standard_scale_by_group", "e2_classification_metrics", "e3_roc_curve", "e6_savings_metric", "m6_knn_classify",
    "t1_clean_table",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
