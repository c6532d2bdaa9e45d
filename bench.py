"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chalkline import registry  # noqa: E402

HEADLINE = (
    "running_best_mastery",
    "running_best_hot_groups",
    "early_warning_users",
    "comparison_by_region",
    "longest_streak_below",
    "one_row_per_hash",
    "rules_on_lines",
    "orphans_with_null_keys",
    "conditional_aggregates",
    "xml_scan_assessment_results",
    "csv_scan_results",
    "int_enrollments",
    "dim_student",
    "fact_student_mastery_daily",
    "fact_assessment_responses",
    "fact_dq_quarantine_log",
    "agg_early_warning",
    "agg_district_comparison",
    "mastery_heatmap",
    "misconception_clusters",
    "curriculum_lift",
    "enrolment_summary",
    "prerequisite_failures",
    "routing_totals",
    "pii_inventory",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chalkline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = registry.load()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:  # one untimed round, so that the times are of the queries and not of class loading
        run(name)
    times = {name: round(run(name), 3) for name in HEADLINE}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
