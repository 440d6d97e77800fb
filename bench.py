"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (optional comma list).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from cardloom.catalog import load

HEADLINE = [
    "card_feature_table", "multi_statistic_table", "skewness_and_variance", "cumulative_lag_slices", "group_median_attach",
    "category_profile_with_missing", "two_level_statistics", "change_summary_per_grouping", "weekly_spend_pivot",
    "distinct_count_ratios", "label_codes", "out_of_fold_rates", "purchase_time_gaps", "text_per_card", "token_counts",
    "chi_square_top_tokens", "svd_row_energy", "correlation_matrix", "roc_auc",
    "staged_card_features", "large_card_features", "outlier_feature_table", "outlier_rate_table", "nmf_count_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("cardloom-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = load()
    queries["class_counts"].run(spark, sf_dir).collect()  # start the engine before the clock
    seconds = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        start = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
