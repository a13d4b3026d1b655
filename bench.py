"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from catalog.queries import all_queries  # noqa: E402
from scoreloom.sources.applicants import applicant_table  # noqa: E402

HEADLINE = (
    "a1_applicant_scan",
    "c1_medians",
    "c4_cap_audit",
    "c6_standardized",
    "c8_split",
    "d4_describe",
    "d6_class_histograms",
    "d8_box_statistics",
    "d12_correlations",
    "d14_rate_by_bucket",
    "e3_woe_table",
    "e4_iv_summary",
    "e7_woe_dataset",
    "f1_standardized_fit",
    "f3_woe_fit",
    "f5_saturated_cross_validation",
    "g1_auc_by_split",
    "g6_ks_curve",
    "g13_benchmark_gate",
    "g14_model_comparison",
    "h2_batch_scoring",
    "h5_top_drivers",
    "h9_stream_scoring",
    "h10_portfolio_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scoreloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    registered = all_queries()
    timings: dict[str, float] = {}
    start = time.perf_counter()
    applicant_table(spark, folder).write.format("noop").mode("overwrite").save()
    timings["derive_applicants"] = time.perf_counter() - start
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = time.perf_counter() - start
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timings.items()},
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
