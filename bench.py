"""Times the headline queries and prints one JSON line.

Each query runs to a full materialization of its rows: one warm-up, then the median of
three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from zephyrine.registry import QUERIES  # noqa: E402
from zephyrine.session import build_session  # noqa: E402

HEADLINE = [
    "w6_daily_lag_features",
    "w6_reading_lag_features_blocked",
    "w7_w10_hourly_lag_features",
    "w11_latest_inference_row",
    "w12_aqi_change_rate",
    "sk1_upsert",
    "a1_daily_pm25_mean",
    "a2_describe_column",
    "a2_describe_column_ranked",
    "a4_monthly_aqi",
    "pf1_assemble_feature_row",
    "pf10_rule_counts",
    "j3_combine_sources",
    "s1_pm25_to_aqi",
    "m3_ridge_two_inputs",
    "m10_recursive_forecast",
    "m12_attribute_sampled",
    "st1_stream_hourly_features",
]
RUNS = 3


def run(spark, name: str, sf_dir: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    spark = build_session(
        "zephyrine-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
    for name in HEADLINE:
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
