from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import day, physical_plan, series
from zephyrine.operators import blocks
from zephyrine.operators.blocks import number_rows, over_series, written_slices
from zephyrine.operators.joins import previous_reading
from zephyrine.operators.projection import align_columns, assemble_feature_rows, feature_columns
from zephyrine.operators.series import (
    add_change_rate,
    add_daily_lag_features,
    add_hourly_lag_features,
    calendar_lag,
    latest_inference_rows,
    resample_latest,
)
from zephyrine.schema import FEATURE_TABLE_COLUMNS
from zephyrine.sources.tables import latest_rows


def test_lag_frame(spark):
    rows = series(spark, [100.0, 110.0, 120.0, 130.0, 140.0, 150.0])
    out = add_daily_lag_features(rows, lookback_days=3).orderBy("timestamp").collect()
    assert len(out) == 4
    first = out[0]
    assert (first["aqi"], first["aqi_lag_1d"], first["target_aqi_1d"]) == (110.0, 100.0, 120.0)
    assert first["aqi_rolling_std_7d"] == 0.0
    assert "aqi_lag_3d" in first.asDict() and "aqi_lag_7d" not in first.asDict()
    assert out[-1]["target_aqi_2d"] is None


def test_lag_columns_are_required(spark):
    with pytest.raises(ValueError, match=r"\['humidity'\]"):
        add_daily_lag_features(series(spark, [1.0]).drop("humidity"))


def test_features_do_not_see_the_future(spark):
    values = [float(v) for v in range(30)]
    changed = values[:20] + [999.0] * 10
    before = day(20)

    def features(v):
        rows = add_daily_lag_features(series(spark, v), drop=False).filter(F.col("timestamp") < F.lit(before))
        return rows.drop("target_aqi_1d", "target_aqi_2d", "target_aqi_3d").orderBy("timestamp").collect()

    assert features(values) == features(changed)


def test_rolling_matches_plain_python_with_gaps(spark):
    rng = random.Random(3)
    values = [None if rng.random() < 0.3 else rng.uniform(0, 300) for _ in range(40)]
    out = add_daily_lag_features(series(spark, values), drop=False).orderBy("timestamp").collect()
    for i, row in enumerate(out):
        window = [v for v in values[max(0, i - 7) : i] if v is not None]
        mean = statistics.fmean(window) if window else None
        spread = statistics.stdev(window) if len(window) > 1 else 0.0
        assert row["aqi_rolling_mean_7d"] == (pytest.approx(mean) if window else None)
        assert row["aqi_rolling_std_7d"] == pytest.approx(spread)


def test_hourly_windows_must_be_full(spark):
    values: list[float | None] = [float(v) for v in range(12)]
    values[3] = None
    out = add_hourly_lag_features(series(spark, values)).orderBy("timestamp").collect()
    filled = [i for i, r in enumerate(out) if r["aqi_rolling_mean_6h"] is not None]
    assert filled == [10, 11]
    assert out[10]["aqi_rolling_mean_6h"] == pytest.approx(statistics.fmean(range(4, 10)))
    assert "pm25_lag_1h" not in out[0].asDict()


@pytest.mark.parametrize("block_rows", [14, 20, 33, 1000])
def test_blocks_equal_whole_series(spark, block_rows):
    rng = random.Random(block_rows)
    rows = series(spark, [rng.uniform(0, 300) for _ in range(150)], "long")
    rows = rows.unionByName(series(spark, [1.0, None, 3.0], "short"))
    rows = rows.unionByName(series(spark, [5.0] * 20, None))
    plain = add_daily_lag_features(rows, drop=False)
    blocked = add_daily_lag_features(rows, drop=False, block_rows=block_rows)
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


def test_blocks_equal_whole_series_for_hourly_frames(spark):
    rng = random.Random(1)
    rows = series(spark, [rng.uniform(0, 300) for _ in range(600)])
    plain = add_hourly_lag_features(rows)
    blocked = add_hourly_lag_features(rows, block_rows=170)
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


def test_blocks_must_hold_the_frame(spark):
    with pytest.raises(ValueError, match="at least 14"):
        over_series(series(spark, [1.0]), ["city"], ["timestamp"], lambda w: {}, 14, 3, block_rows=5)


def test_positions_are_global_row_numbers(spark):
    rows = series(spark, [1.0] * 500, "a").unionByName(series(spark, [1.0] * 3, "b"))
    got = number_rows(rows, ["city"], ["timestamp"])
    spans = got.groupBy("city").agg(
        F.min("position"), F.max("position"), F.count_distinct("position")
    ).orderBy("city")
    assert [tuple(r) for r in spans.collect()] == [("a", 0, 499, 500), ("b", 0, 2, 3)]


def test_a_hot_series_is_spread_over_slices(spark):
    hot = F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    rows = spark.range(40_000).select(
        hot.alias("city"), (F.col("id") % 3).alias("timestamp"), "id", F.rand(1).alias("aqi")
    )
    sizes = [
        r["count"]
        for r in written_slices(rows, ["city"], ["timestamp", "id"]).groupBy("_slice").count().collect()
    ]
    assert len(sizes) == 8 and sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / 8
    placed = number_rows(rows, ["city"], ["timestamp", "id"])
    same = F.row_number().over(Window.partitionBy("city").orderBy("timestamp", "id")) - 1
    assert placed.withColumn("same", same).filter("same <> position").count() == 0


def test_change_rate_over_series(spark):
    out = add_change_rate(series(spark, [100.0, 120.0, 0.0, 50.0, None, 60.0])).orderBy("timestamp")
    assert [r["aqi_change_rate"] for r in out.collect()] == [0.0, 20.0, -100.0, 0.0, 0.0, 0.0]


def test_late_reading_is_compared_with_its_own_past(spark):
    rows = series(spark, [100.0, 110.0, 121.0, 130.0])
    late = rows.filter("aqi = 121")
    got = previous_reading(rows.filter("aqi <> 121"), late).first()
    assert (got["previous_aqi"], got["aqi_change_rate"]) == (110.0, 10.0)


def test_resampling_keeps_the_latest_reading_of_a_slot(spark):
    rows = spark.createDataFrame(
        [("a", 1, day(0, 9), 1.0), ("a", 3, day(0, 17), 2.0), ("a", 2, day(0, 17), 3.0), ("a", 4, day(1), 4.0)],
        "city STRING, reading_id INT, timestamp TIMESTAMP, aqi DOUBLE",
    )
    got = resample_latest(rows, ["city"], "day", ["timestamp", "reading_id"]).orderBy("timestamp")
    assert [r["reading_id"] for r in got.collect()] == [3, 4]


def test_calendar_lag_ignores_missing_days(spark):
    rows = series(spark, [1.0, 2.0, 3.0, 4.0, 5.0]).filter("aqi <> 3")
    got = calendar_lag(rows, 1).orderBy("timestamp").collect()
    assert [r["aqi_calendar_lag_1d"] for r in got] == [None, 1.0, None, 4.0]


def test_calendar_lag_across_midnight_equals_a_scan(spark):
    rng = random.Random(8)
    hours = sorted(rng.sample(range(24 * 12), 120))
    rows = spark.createDataFrame([("a", day(h // 24, h % 24), float(h)) for h in hours], "city STRING, timestamp TIMESTAMP, aqi DOUBLE")
    for days in (1, 3):
        got = {r["aqi"]: r["lag"] for r in calendar_lag(rows, days, name="lag").collect()}
        for h in hours:
            seen = [x for x in hours if h - 24 * (days + 1) < x <= h - 24 * days]
            assert got[float(h)] == (float(seen[-1]) if seen else None)
    with pytest.raises(ValueError, match="one day"):
        calendar_lag(rows, 0)


def test_latest_inference_row_needs_72_rows_of_history(spark):
    rows = series(spark, [float(v) for v in range(80)], "long").unionByName(
        series(spark, [1.0] * 72, "short")
    )
    got = latest_inference_rows(rows, ["aqi_lag_72h", "aqi", "dew_point"]).collect()
    assert [r["city"] for r in got] == ["long"]
    assert (got[0]["aqi"], got[0]["aqi_lag_72h"], got[0]["dew_point"]) == (79.0, 7.0, None)


def test_feature_rows_have_the_fixed_columns(spark):
    rows = series(spark, [100.0, 120.0]).withColumns(
        {"pressure": F.lit(1000.0), "wind_speed": F.lit(4.0), "pm25": F.lit(float("nan"))}
    )
    out = assemble_feature_rows(rows)
    assert out.columns == list(FEATURE_TABLE_COLUMNS) and len(out.columns) == 31
    assert dict(out.dtypes)["no2"] == "double" and dict(out.dtypes)["is_weekend"] == "int"
    assert "aqi" not in feature_columns(out) and "pm25" in feature_columns(out)
    assert align_columns(out, ["x", "pm25"]).columns == ["x", "pm25"]


def test_latest_rows_uses_the_whole_order(spark):
    rows = spark.createDataFrame(
        [("a", day(0), 1, 5.0), ("a", day(0), 2, None)], "city STRING, timestamp TIMESTAMP, n INT, aqi DOUBLE"
    )
    assert latest_rows(rows, order=["timestamp", "n"]).first()["n"] == 2


def test_daily_features_take_one_exchange_and_one_sort(spark):
    plan = physical_plan(add_daily_lag_features(series(spark, [1.0] * 5).cache()))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 1
