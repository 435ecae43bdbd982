"""Plan shapes that must hold at any size."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import physical_plan
from zephyrine.operators.profiling import daily_pm25_mean
from zephyrine.operators.quality import recent_above
from zephyrine.operators.ranking import time_split
from zephyrine.operators.series import add_hourly_lag_features, latest_inference_rows
from zephyrine.plans.forecast import latest_feature_rows
from zephyrine.registry import QUERIES
from zephyrine.registry.base import READING_ORDER, daily, hourly, readings
from zephyrine.sources.tables import latest_rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# Queries that write tables or fit models while they are built.
EAGER = ("e1", "sc", "sk", "so2", "st", "m3", "m4", "m8", "m9", "m11", "m12", "a2", "a10", "a11")
BOUNDED_RANGE_JOIN = {"j5_breakpoint_join"}  # seven literal rows


@pytest.mark.parametrize(
    "name", sorted(n for n in QUERIES if not n.startswith(EAGER) and n not in BOUNDED_RANGE_JOIN)
)
def test_no_cross_join_and_no_python(spark, name):
    plan = physical_plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan, plan


def test_latest_row_is_reduced_before_the_shuffle(spark):
    plan = physical_plan(latest_rows(readings(spark, SF_DIR), ["city"], READING_ORDER))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max" in plan.split("Exchange hashpartitioning")[1]


def test_rank_filters_prune_before_the_shuffle(spark):
    plan = physical_plan(recent_above(readings(spark, SF_DIR), order=READING_ORDER))
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[-1]


def test_hourly_features_share_one_exchange_and_sort(spark):
    plan = physical_plan(add_hourly_lag_features(hourly(spark, SF_DIR)))
    window = plan.split("Window [")
    assert len(window) == 2
    assert window[1].count("Exchange hashpartitioning") == 2  # resample, then series


def test_daily_mean_scans_only_its_columns(spark):
    rows = readings(spark, SF_DIR).withColumn("day", F.to_date("ts"))
    plan = daily_pm25_mean(rows, value="pm25")._jdf.queryExecution().toString()
    scan = plan[plan.rindex("ReadSchema") :]
    assert "props" not in scan and "user_id" not in scan and "event_type" in scan


def test_time_cutoff_reaches_the_scan(spark):
    _, test = time_split(spark.read.parquet(f"{SF_DIR}/events.parquet"), 7, "ts")
    formatted = test._jdf.queryExecution().explainString(
        test.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThan(ts,ScalarSubquery" in formatted, formatted


def test_latest_features_prune_to_the_rows_the_frames_reach(spark):
    table = daily(spark, SF_DIR, ["aqi", "temperature", "humidity"])
    plan = physical_plan(latest_feature_rows(table, ["station_id"]))
    series = plan.split("Exchange hashpartitioning(station_id")[1]
    assert "WindowGroupLimit" in series


def test_latest_inference_rows_take_one_exchange_over_the_table(spark):
    table = hourly(spark, SF_DIR, ["aqi", "pm25", "wind_speed"])
    plan = physical_plan(latest_inference_rows(table))
    assert plan.count("Exchange hashpartitioning") == 2  # resample, then series


def test_daily_resample_partial_aggregate(spark):
    assert "partial_max" in physical_plan(daily(spark, SF_DIR))
