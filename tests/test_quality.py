from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.helpers import day, series
from zephyrine.operators import ranking
from zephyrine.operators.profiling import (
    backfill_summary,
    describe_column,
    distinct_count,
    duplicate_rows,
    missing_counts,
    regression_metrics,
    table_profile,
)
from zephyrine.operators.quality import (
    count_violations,
    frame_rules,
    ingest_rules,
    min_rows_guard,
    recent_above,
    split_valid,
    validate_feature_frame,
    with_violations,
)
from zephyrine.operators.quantiles import exact_quantiles
from zephyrine.operators.ranking import rank_models, time_split, top_values

COLUMNS = (
    "city STRING, timestamp STRING, aqi DOUBLE, temperature DOUBLE, humidity DOUBLE, "
    "pressure DOUBLE, wind_speed DOUBLE"
)
GOOD = ("harbour", "2026-06-08T00:00:00Z", 120.0, 33.0, 45.0, 1004.0, 2.5)


def frame(spark, **changes):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    row = {**dict(zip(names, GOOD)), **changes}
    return spark.createDataFrame([tuple(row[n] for n in names)], COLUMNS)


def test_valid_frame_comes_back_in_utc(spark):
    out = validate_feature_frame(frame(spark))
    assert dict(out.dtypes)["timestamp"] == "timestamp"
    assert out.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm")).first()[0] == "2026-06-08 00:00"


@pytest.mark.parametrize(
    ("changes", "message"),
    [
        ({"aqi": 900.0}, "AQI: outside"),
        ({"aqi": None}, "AQI: no value"),
        ({"timestamp": "soon"}, "readable time"),
        ({"humidity": 101.0}, "humidity"),
        ({"humidity": None}, "humidity"),
        ({"temperature": None}, "temperature"),
        ({"temperature": 71.0}, "temperature"),
        ({"pressure": 0.0}, "pressure"),
        ({"wind_speed": -0.1}, "wind speed"),
    ],
)
def test_bad_rows_are_rejected(spark, changes, message):
    with pytest.raises(ValueError, match=message):
        validate_feature_frame(frame(spark, **changes))


@pytest.mark.parametrize("changes", [{"pressure": None}, {"wind_speed": None}])
def test_missing_pressure_and_wind_pass(spark, changes):
    assert validate_feature_frame(frame(spark, **changes)).count() == 1


def test_missing_columns_and_empty_frames_are_rejected(spark):
    with pytest.raises(ValueError, match=r"Missing required columns: \['pressure'\]"):
        validate_feature_frame(frame(spark).drop("pressure"))
    with pytest.raises(ValueError, match="empty"):
        validate_feature_frame(frame(spark).limit(0))


def test_quarantine_keeps_every_row_once(spark):
    rows = frame(spark).unionByName(frame(spark, aqi=900.0, wind_speed=-1.0)).unionByName(
        frame(spark, aqi=None)
    )
    good, bad = split_valid(rows, frame_rules())
    assert good.count() == 1 and bad.count() == 2
    broken = {tuple(r["violations"]) for r in bad.collect()}
    assert broken == {("aqi_range", "wind_speed"), ("aqi_missing", "aqi_range")}
    counts = {r["rule"]: r["broken_rows"] for r in count_violations(rows, frame_rules()).collect()}
    assert counts["aqi_range"] == 2 and counts["pressure"] == 0


def test_ingest_guard_is_strict_about_minus_90(spark):
    rows = frame(spark, temperature=-90.0)
    assert with_violations(rows, ingest_rules()).first()["violations"] == ["temperature"]
    assert with_violations(rows, frame_rules()).first()["violations"] == []


def test_min_rows_guard(spark):
    with pytest.raises(ValueError, match="49 rows"):
        min_rows_guard(spark.range(49))
    assert min_rows_guard(spark.range(50)).count() == 50


def test_recent_above_needs_more_than_five_rows(spark):
    few = series(spark, [80.0] * 5 + [10.0], "few")
    many = series(spark, [80.0] * 100 + [10.0] * 20, "many")
    got = recent_above(few.unionByName(many))
    assert {r["city"] for r in got.collect()} == {"many"} and got.count() == 90
    assert got.agg(F.min("timestamp")).first()[0] == day(10).replace(tzinfo=None)


def test_quantiles_interpolate_and_skip_missing_values(spark):
    values = [1.0, 2.0, 3.0, 10.0, 10.0, None, 4.0]
    rows = spark.createDataFrame([(v, 1.0, None) for v in values], "a DOUBLE, b DOUBLE, c DOUBLE")
    got = exact_quantiles(rows, ["a", "b", "c"], [0.0, 0.25, 0.5, 0.9, 1.0])
    assert got["a"] == pytest.approx([1.0, 2.25, 3.5, 10.0, 10.0])
    assert got["b"] == [1.0] * 5 and got["c"] == [None] * 5


def test_quantiles_of_values_of_all_magnitudes(spark):
    values = [(-1.0) ** i * 10.0 ** (i % 617 - 308) for i in range(2000)] + [0.0, 1.7e308, -1.7e308]
    rows = spark.createDataFrame([(v,) for v in values], "a DOUBLE")
    ordered = sorted(values)
    got = exact_quantiles(rows, ["a"], [0.25, 0.5])["a"]
    assert got == [pytest.approx(ordered[500] * 0.5 + ordered[501] * 0.5, rel=0.6), ordered[1001]]


def test_median_is_exact(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "a DOUBLE")
    assert exact_quantiles(rows, ["a"], [0.5]) == {"a": [2.5]}


def test_describe_and_profile(spark):
    rows = series(spark, [1.0, 2.0, 3.0, 4.0, None])
    got = describe_column(rows, "aqi").first()
    assert (got["count"], got["mean"], got["min"], got["p50"], got["max"]) == (4, 2.5, 1.0, 2.5, 4.0)
    assert got["std"] == pytest.approx(1.2909944487)
    assert distinct_count(rows, "aqi").first()[0] == 4
    profile = table_profile(rows).first()
    assert (profile["rows"], profile["columns"], profile["distinct_values"]) == (5, 5, 4)


def test_missing_values_count_null_and_nan(spark):
    rows = spark.createDataFrame(
        [(1.0, None, "a"), (float("nan"), None, "b")], "x DOUBLE, y DOUBLE, z STRING"
    )
    assert {tuple(r) for r in missing_counts(rows).collect()} == {("x", 1), ("y", 2)}


def test_duplicates_treat_missing_as_equal(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a INT, b INT")
    assert duplicate_rows(rows).first()[0] == 1
    assert duplicate_rows(rows.limit(0)).first()[0] == 0


def test_time_split_is_disjoint_and_complete(spark):
    rows = series(spark, [float(i) for i in range(20)])
    train, test = time_split(rows, 7)
    assert train.count() == 13 and test.count() == 7
    assert train.intersect(test).count() == 0
    assert train.unionByName(test).exceptAll(rows).count() == 0


def test_many_cities_are_split_without_a_broadcast(spark, monkeypatch):
    rows = series(spark, [1.0] * 10).unionByName(series(spark, [1.0] * 4, "town"))
    plain = [sorted(map(tuple, part.collect())) for part in time_split(rows, 2, per_city=True)]
    monkeypatch.setattr(ranking, "BROADCAST_CITIES", 0)
    assert [sorted(map(tuple, part.collect())) for part in time_split(rows, 2, per_city=True)] == plain


def test_time_split_per_city_uses_each_citys_end(spark):
    rows = series(spark, [1.0] * 20, "a").unionByName(series(spark, [1.0] * 5, "b"))
    train, test = time_split(rows, 2, per_city=True)
    assert {r["city"]: r["count"] for r in test.groupBy("city").count().collect()} == {"a": 2, "b": 2}
    assert train.count() == 21


def test_metrics_of_perfect_and_mean_predictions(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0)], "label DOUBLE, prediction DOUBLE")
    assert tuple(regression_metrics(rows).first()) == (2, 0.0, 0.0, 1.0)
    mean = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "label DOUBLE, prediction DOUBLE")
    assert tuple(regression_metrics(mean).first()) == (2, 1.0, 1.0, 0.0)


def test_models_rank_by_error_then_name(spark):
    rows = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "name STRING, rmse DOUBLE")
    assert [r["name"] for r in rank_models(rows).collect()] == ["c", "a", "b"]


def test_top_values_break_ties_by_value(spark):
    rows = series(spark, [3.0, 3.0, 1.0, 2.0, None])
    assert [tuple(r) for r in top_values(rows, n=2).collect()] == [(3.0, 2), (1.0, 1)]


def test_backfill_summary_counts_add_up(spark):
    rows = spark.createDataFrame([("pushed",), ("failed",), ("skipped",), ("pushed",)], "status STRING")
    assert tuple(backfill_summary(rows).first()) == (4, 2, 1, 1)
