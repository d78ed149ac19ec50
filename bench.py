"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace import build_session
from millrace.catalog import QUERIES

HEADLINE = [
    "overview", "describe_numeric", "full_profile", "describe_categorical", "top_values", "missing_report",
    "percentiles", "moments", "drop_duplicates", "coerce_numeric", "detect_column_type", "profile_column_plan",
    "impute_median", "impute_mode", "impute_ffill", "impute_interpolate", "encode_onehot", "encode_label", "encode_frequency",
    "encode_target", "scale_standard", "scale_robust", "feat_rules", "feat_rank_pct", "outlier_clip", "outlier_report",
    "pearson_matrix", "spearman_matrix", "anova_test", "chi_square_test", "mutual_info_matrix", "pairwise_tests",
    "select_cascade", "split_lines", "split_stratified", "histogram", "box_stats", "kde", "apply_fitted", "ml_linear", "ml_tree_cls",
    "kendall_matrix", "knn_neighbours", "impute_ffill_global", "encode_label_wide", "dictionary_lookup_hot", "feat_rank_pct_chunked",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
            "spark.log.level": "ERROR", "spark.ui.showConsoleProgress": "false",
        },
    )
    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    sink(QUERIES["moments"](spark, sf))  # warm-up of the JVM and the file cache
    times: dict[str, float] = {}
    for name in names:
        seen = []
        for _ in range(runs):
            start = time.perf_counter()
            sink(QUERIES[name](spark, sf))
            seen.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seen), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf.rstrip("/").split("sf")[-1]}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
