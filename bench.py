"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from lotmill.session import get_session
from lotmill.workload import QUERIES

HEADLINE = [
    "a2_completeness", "a5_range_checks", "a4_uniqueness", "a6_category_checks", "a7_zscore_outliers", "a8_iqr_outliers",
    "a10_distribution_profile", "a14_pearson_matrix", "a15_spearman_matrix", "f1_domain_bounds", "f9_violation_counts",
    "w1_drop_duplicates", "a24_crosstab", "a25_stacked_top_brands", "a31_box_stats_by_tier", "a42_classification_report",
    "r1_composite_score", "m2_frequency_encoding", "m4_stratified_split", "l4_anova_scores", "d3_merged_sources",
    "tier_distribution_of_clean_listings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = get_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a28_distinct_values"](spark, sf_dir).count()  # warm-up
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            spark.catalog.clearCache()
        times[name] = round(statistics.median(runs), 3)
    print(json.dumps({
        "metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
