"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query is built and run to its end ``RUNS`` times and the median is reported.
The rows go to Spark's ``noop`` sink, so every column is computed and none is
collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.queries import QUERIES  # noqa: E402

HEADLINE = [
    "daily_conversion",
    "flt_05_range",
    "scl_14_ratio",
    "agg_01_global",
    "agg_03_two_keys",
    "agg_05_distinct",
    "agg_10_collect",
    "agg_14_rounded",
    "set_02_first_per_key",
    "srt_03_mixed",
    "srt_05_top_k",
    "jn_03_right",
    "jn_04_full",
    "jn_07_broadcast",
    "jn_08_unhinted",
    "jn_09_join_then_count",
    "win_01_row_number",
    "win_05_top_per_group",
    "win_09_transitions",
    "win_11_moving_average",
    "win_13_lifetime_value",
    "rdd_10_word_count",
    "rdd_11_revenue_from_json",
    "udf_01_built_in",
    "udf_02_by_row",
    "udf_03_vectorised",
    "rdd_09_word_count_rdd",
    "cch_01_cache",
    "jn_10_late_and_early_filter",
    "snk_04_by_date",
    "snk_05_by_date_and_country",
    "lay_01_layouts",
    "cch_03_three_aggregates",
    "lay_02_pruned_columns",
    "src_08_partitioned",
    "snk_01_parquet",
    "med_05_split",
    "med_07_daily_metrics",
    "med_08_user_metrics",
    "med_12_summary",
    "prd_03_null_gate",
    "prd_06_versions",
    "prd_07_point_in_time",
    "prd_08_metric_set",
    "str_02_tumbling",
    "snk_10_durable",
]


RUNS = 3
# Run once before anything is timed, so that the first query does not pay for the start.
WARM_UP = ["flt_05_range", "daily_conversion", "rdd_10_word_count"]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    for name in WARM_UP:
        run(spark, name, folder)
    times = {
        name: round(statistics.median(run(spark, name, folder) for _ in range(RUNS)), 3) for name in names
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
