from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import UTC, day, physical_plan, series
from zephyrine.operators import joins
from zephyrine.operators.joins import combine_sources, with_neighbours
from zephyrine.operators.series import add_change_rate
from zephyrine.plans.ingest import (
    backfill,
    fallback_features,
    history_feature_rows,
    ingest_payloads,
    load_features,
    sifted_payloads,
)
from zephyrine.schema import AQI_PAYLOAD_SCHEMA, FEATURE_TABLE_COLUMNS, WEATHER_PAYLOAD_SCHEMA
from zephyrine.session import scratch_path, scratch_root
from zephyrine.sources.history import scan_history_csv, scan_named_history_csv
from zephyrine.sources.payloads import (
    parse_aqi_payloads,
    parse_weather_payloads,
    read_payload_lines,
    scan_measurement_payloads,
)
from zephyrine.sources.store import (
    latest_per_key,
    load_processed_dates,
    merge_batches,
    save_processed_dates,
    upsert,
    upsert_predictions,
)
from zephyrine.sources.tables import read_feature_table, read_with_fallback


def lines(path, documents) -> str:
    path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
    return str(path)


def aqi_document(hour=6, seq=1, aqi=120, status="ok", **iaqi):
    return {
        "city": "harbour",
        "fetched_at": f"2026-06-08T{hour:02d}:20:00Z",
        "ingest_seq": seq,
        "status": status,
        "data": {"aqi": aqi, "iaqi": {k: {"v": v} for k, v in iaqi.items()}},
    }


def weather_document(hour=6, seq=1, **changes):
    return {
        "city": "harbour",
        "fetched_at": f"2026-06-08T{hour:02d}:25:00Z",
        "ingest_seq": seq,
        "main": {"temp": 30, "humidity": 60, "pressure": 1000},
        "wind": {"speed": 4},
        "weather": [{"description": "haze"}, {"description": "dust"}],
        **changes,
    }


def test_aqi_payloads_split_into_rows_and_rejects(spark, tmp_path):
    path = lines(
        tmp_path / "a.json", [aqi_document(pm25=40.5), aqi_document(status="error"), "{broken"]
    )
    good, bad = parse_aqi_payloads(read_payload_lines(spark, path, AQI_PAYLOAD_SCHEMA))
    row = good.first()
    assert good.count() == 1 and (row["aqi"], row["pm25"], row["pm10"]) == (120.0, 40.5, None)
    reasons = sorted(r["reject_reason"] for r in bad.collect())
    assert reasons == ["malformed payload", "status is not ok"]


def test_weather_payloads_need_the_mandatory_fields(spark, tmp_path):
    path = lines(
        tmp_path / "w.json",
        [weather_document(), weather_document(wind={}), weather_document(weather=[])],
    )
    good, bad = parse_weather_payloads(read_payload_lines(spark, path, WEATHER_PAYLOAD_SCHEMA))
    row = good.first()
    assert (row["weather_desc"], row["wind_direction"], row["visibility"]) == ("haze", None, None)
    reasons = sorted(r["reject_reason"] for r in bad.collect())
    assert reasons == ["missing weather_desc", "missing wind_speed"]


def test_every_measurement_is_read(spark, tmp_path):
    document = {
        "city": "harbour",
        "ingest_seq": 1,
        "date": "2026-01-01",
        "results": [{"value": v} for v in range(150)],
    }
    rows = scan_measurement_payloads(spark, lines(tmp_path / "m.json", [document]))
    assert sorted(r["value"] for r in rows.collect()) == [float(v) for v in range(150)]


def test_history_csv_by_position(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("Date , PM2.5\n2026/1/2, 40\n2026/1/1,\n2026-01-03, n/a\n2026-01-04,12.5\n")
    got = scan_history_csv(spark, str(path)).orderBy("timestamp").collect()
    assert [(r["timestamp"].day, r["pm25"]) for r in got] == [(2, 40.0), (4, 12.5)]
    for value in ("40", ""):
        path.write_text(f"date,pm25\nyesterday,{value}\n")
        with pytest.raises(Exception, match="unreadable date"):
            scan_history_csv(spark, str(path)).select("pm25").collect()


def test_named_history_csv_is_strict(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("date, pm25\n2026/1/2, 40\n")
    assert scan_named_history_csv(spark, str(path), "harbour").first()["city"] == "harbour"
    path.write_text("day,pm25\n2026/1/2,40\n")
    with pytest.raises(ValueError, match="'date'"):
        scan_named_history_csv(spark, str(path), "harbour")


def test_sources_pair_by_city_and_hour(spark, tmp_path):
    aqi = lines(
        tmp_path / "a.json",
        [aqi_document(6, 1, 100), aqi_document(6, 2, 110), aqi_document(7, 3, 120)],
    )
    weather = lines(tmp_path / "w.json", [weather_document(6, 1), weather_document(9, 2)])
    good = parse_aqi_payloads(read_payload_lines(spark, aqi, AQI_PAYLOAD_SCHEMA))[0]
    other = parse_weather_payloads(read_payload_lines(spark, weather, WEATHER_PAYLOAD_SCHEMA))[0]
    got = combine_sources(good, other).collect()
    assert [(r["timestamp"].hour, r["aqi"], r["temperature"]) for r in got] == [(6, 110.0, 30.0)]


def test_live_ingest_compares_with_the_stored_past(spark, tmp_path):
    table = str(tmp_path / "features")
    for hour, aqi in ((6, 100), (8, 150), (7, 120), (8, 60), (9, 700)):
        a = lines(tmp_path / f"a{hour}-{aqi}.json", [aqi_document(hour, 1, aqi)])
        w = lines(tmp_path / f"w{hour}-{aqi}.json", [weather_document(hour, 1)])
        seq = hour * 1000 + aqi if hour != 8 else aqi * -1
        stored = ingest_payloads(spark, a, w, table, seq, str(tmp_path / "rejects"))
    rows = {r["timestamp"].hour: r for r in stored.collect()}
    assert set(rows) == {6, 7, 8}  # the 700 fails the guard
    assert rows[7]["aqi_change_rate"] == 20.0
    assert (rows[8]["aqi"], rows[8]["aqi_change_rate"]) == (60.0, -50.0)
    assert rows[6]["temp_humidity_index"] == 18.0
    assert set(FEATURE_TABLE_COLUMNS) <= set(stored.columns)


def test_upsert_replaces_inserts_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")

    def batch(rows):
        return spark.createDataFrame(rows, "city STRING, timestamp TIMESTAMP, aqi DOUBLE, ingest_seq LONG")

    first = batch([("a", day(0, 1), 1.0, 1), ("a", day(0, 1), 2.0, 2), ("a", day(1), 3.0, 1)])
    upsert(spark, path, first)
    day_one = {f for d, _, fs in os.walk(path) if "2026-01-02" in d for f in fs}
    second = batch([("a", day(0, 1), 9.0, 3), ("b", day(0, 1), 5.0, 3), ("a", day(0, 1), 8.0, 1)])
    for _ in range(2):
        got = upsert(spark, path, second)
        keyed = {(r["city"], r["timestamp"]): r["aqi"] for r in got.collect()}
        assert got.count() == 3 and sorted(keyed.values()) == [3.0, 5.0, 9.0]
    assert day_one == {f for d, _, fs in os.walk(path) if "2026-01-02" in d for f in fs}
    assert upsert(spark, path, second.limit(0)).count() == 3
    with pytest.raises(ValueError, match="without a timestamp"):
        upsert(spark, path, batch([("a", None, 1.0, 1)]))


def test_a_died_swap_is_finished_by_the_next_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "city STRING, timestamp TIMESTAMP, aqi DOUBLE, ingest_seq LONG"
    upsert(spark, path, spark.createDataFrame([("a", day(0), 1.0, 1)], schema))
    merged = spark.createDataFrame([("a", day(0), 1.0, 1), ("b", day(0), 2.0, 2)], schema)
    dated = merged.withColumn("event_date", F.to_date("timestamp"))
    dated.write.partitionBy("event_date").parquet(path + "__pending")
    for name in os.listdir(path):
        if name.startswith("event_date"):  # the old partition is gone, the new one not yet there
            os.rename(os.path.join(path, name), str(tmp_path / name))
    got = upsert(spark, path, spark.createDataFrame([("c", day(0), 3.0, 3)], schema))
    assert sorted(r["city"] for r in got.collect()) == ["a", "b", "c"]
    assert not os.path.exists(path + "__pending")


def test_latest_per_key_collapses_copies(spark):
    rows = spark.range(10_000).select(
        F.lit("a").alias("city"), F.lit(day(0)).alias("timestamp"), "id", (F.col("id") % 7).alias("ingest_seq")
    )
    got = latest_per_key(rows).collect()
    assert len(got) == 1 and got[0]["ingest_seq"] == 6


def test_batches_merge_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x INT, y INT")
    b = spark.createDataFrame([(3,)], "y INT")
    assert sorted(map(tuple, merge_batches([a, b]).collect()), key=str) == [(1, 2), (None, 3)]
    with pytest.raises(ValueError):
        merge_batches([])


def test_reads_are_pruned_to_the_wanted_days(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, series(spark, [float(i) for i in range(10)]).withColumn("ingest_seq", F.lit(1)))
    rows = read_feature_table(
        spark, path, ["city", "aqi"], since=dt.date(2026, 1, 3), until=dt.date(2026, 1, 5), city="harbour"
    )
    assert sorted(r["aqi"] for r in rows.collect()) == [2.0, 3.0, 4.0]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "EqualTo(city,harbour)" in plan


def test_fallback_is_used_when_the_table_is_missing(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("date,pm25\n2026/1/2,40\n")
    got = load_features(spark, str(tmp_path / "none"), str(path), "harbour").first()
    assert (got["aqi"], got["temperature"], got["pressure"]) == (112.1, 9.5, 1018.0)
    rows, source = read_with_fallback(lambda: spark.range(3), lambda: spark.range(1))
    assert (rows.count(), source) == (3, "primary")
    assert fallback_features(spark, str(path), "harbour").count() == 1


def test_history_rows_are_stamped_at_noon_with_midnight_features(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("date,pm25\n2026/1/2,40\n2026/1/3,20\n")
    got = history_feature_rows(spark, str(path), "harbour").orderBy("timestamp").collect()
    assert [r["timestamp"].hour for r in got] == [12, 12] and got[0]["hour"] == 0
    assert got[1]["aqi_change_rate"] == round((got[1]["aqi"] - got[0]["aqi"]) / got[0]["aqi"] * 100, 4)


def test_backfill_resumes_and_a_dry_run_commits_nothing(spark, tmp_path):
    rows = [(day(i).date(), float(10 * i - 10)) for i in range(4)]  # day 0 has only -10
    measurements = spark.createDataFrame(rows, "day DATE, value DOUBLE")
    spine = measurements.select("day").unionByName(
        spark.createDataFrame([(day(9).date(),)], "day DATE")
    )
    table, done = str(tmp_path / "t"), str(tmp_path / "done")
    args = (spark, measurements, spine, table, done, 1, "harbour")
    dry = tuple(backfill(*args, dry_run=True).first())
    assert dry == (5, 3, 0, 2) and load_processed_dates(spark, done, True).count() == 0
    assert tuple(backfill(*args).first()) == (5, 3, 0, 2)
    assert spark.read.parquet(table).count() == 3
    assert tuple(backfill(*args).first()) == (5, 0, 5, 0)
    save_processed_dates(spine.withColumn("city", F.lit("harbour")), done)
    assert load_processed_dates(spark, done, True).count() == 5


def test_a_resumed_backfill_goes_on_from_the_stored_day(spark, tmp_path):
    values = [("a", i, 20.0 + 10 * i) for i in range(3)] + [("b", i, 50.0 - 10 * i) for i in range(3)]
    rows = spark.createDataFrame([(c, day(i).date(), v) for c, i, v in values], "city STRING, day DATE, value DOUBLE")
    stored = {}
    for name, spans in (("whole", [3]), ("resumed", [2, 3])):
        table, done = str(tmp_path / name), str(tmp_path / (name + "-done"))
        for seq, n in enumerate(spans):
            span = rows.filter(F.col("day") < F.lit(day(n).date()))
            backfill(spark, span, span.select("day"), table, done, seq)
        stored[name] = {
            (r["city"], r["timestamp"]): r["aqi_change_rate"] for r in spark.read.parquet(table).collect()
        }
    assert stored["whole"] == stored["resumed"] and len(stored["whole"]) == 6


def test_payloads_that_are_turned_down_are_kept_or_fail(spark, tmp_path):
    aqi = lines(tmp_path / "a.json", [aqi_document(6, 1, 100), aqi_document(7, 2, 900)])
    weather = lines(tmp_path / "w.json", [weather_document(6, 1), weather_document(7, 2), weather_document(wind={})])
    table, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    with pytest.raises(ValueError, match="turned down"):
        ingest_payloads(spark, aqi, weather, table, 1)
    assert ingest_payloads(spark, aqi, weather, table, 1, rejects).count() == 1
    found = sorted((r["source"], r["reason"]) for r in spark.read.parquet(rejects).collect())
    assert found == [("aqi", "outside the ingest rules"), ("weather", "missing wind_speed")]


def test_each_side_is_scanned_once_for_what_is_turned_down(spark, tmp_path):
    """Raw rows of unreadable payloads and parsed ones of those outside the rules, from one scan a side."""
    aqi = lines(tmp_path / "a.json", [aqi_document(6, 1, 100), aqi_document(7, 2, 900), aqi_document(6, 3, 110)])
    weather = lines(tmp_path / "w.json", [weather_document(6, 1), weather_document(7, 2), weather_document(wind={})])
    good, _, refused = sifted_payloads(
        read_payload_lines(spark, aqi, AQI_PAYLOAD_SCHEMA), read_payload_lines(spark, weather, WEATHER_PAYLOAD_SCHEMA)
    )
    assert good.count() == 2 and physical_plan(refused).count("FileScan json") == 2
    rows = {r["source"]: json.loads(r["row"]) for r in refused.collect()}
    assert rows["aqi"]["aqi"] == 900.0 and "data" not in rows["aqi"]
    assert "main" in rows["weather"] and "temperature" not in rows["weather"]


def test_predictions_are_keyed_by_city_and_time(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", day(0), 1.0, 2.0, 3.0)],
        "city STRING, timestamp TIMESTAMP, aqi_pred_24h DOUBLE, aqi_pred_48h DOUBLE, aqi_pred_72h DOUBLE",
    )
    path = str(tmp_path / "p")
    for seq in (1, 2):
        stored = upsert_predictions(spark, path, rows, dt.datetime(2026, 1, 1, seq, tzinfo=UTC), seq)
    assert stored.count() == 1
    assert stored.select(F.hour("predicted_at")).first()[0] == 2


def sequenced(df, seq):
    return df.withColumn("ingest_seq", F.lit(seq).cast("bigint"))


def test_neighbours_are_one_row_per_city_on_either_side(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, sequenced(series(spark, [float(i) for i in range(10)]), 1))
    batch = sequenced(series(spark, [1.0] * 10).filter(F.dayofmonth("timestamp") >= 9), 2)
    placed = with_neighbours(batch, path)
    assert sorted(r["timestamp"].day for r in placed.filter(~F.col("_new")).collect()) == [8]
    # A late day is stored again together with the day after it.
    late = sequenced(series(spark, [1.0] * 10).filter(F.dayofmonth("timestamp").isin(3, 9)), 2)
    placed = with_neighbours(late, path)
    assert sorted(r["timestamp"].day for r in placed.filter("_new").collect()) == [3, 4, 9, 10]
    assert sorted(r["timestamp"].day for r in placed.filter("NOT _new").collect()) == [2, 8]


def test_neighbours_are_found_across_a_gap(spark, tmp_path):
    path = str(tmp_path / "t")
    old = series(spark, [float(i + 1) for i in range(40)]).filter("dayofyear(timestamp) IN (1, 40)")
    upsert(spark, path, sequenced(old, 1))
    batch = sequenced(series(spark, [100.0] * 40).filter("dayofyear(timestamp) = 20"), 2)
    placed = {r["timestamp"].timetuple().tm_yday: r["_new"] for r in with_neighbours(batch, path).collect()}
    assert placed == {1: False, 20: True, 40: True}


def test_one_new_hour_reads_two_days_of_a_long_table(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, sequenced(series(spark, [float(i) for i in range(300)]), 1))
    batch = sequenced(series(spark, [5.0] * 301).orderBy(F.desc("timestamp")).limit(1), 2)
    read = []
    original = joins._nearest

    def watched(spark_, table, wanted, edge, ahead):
        found = original(spark_, table, wanted, edge, ahead)
        read.append(None if found is None else found.count())
        return found

    joins._nearest = watched
    try:
        placed = with_neighbours(batch, path)
    finally:
        joins._nearest = original
    assert read == [1, None] and placed.count() == 2


def test_a_late_older_reading_does_not_replace_the_stored_one(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "city STRING, timestamp TIMESTAMP, aqi DOUBLE, ingest_seq BIGINT"
    upsert(spark, path, spark.createDataFrame([("a", day(0, 10), 100.0, 55)], schema))
    batch = spark.createDataFrame([("a", day(0, 10), 50.0, 20), ("a", day(0, 11), 110.0, 65)], schema)
    rows = add_change_rate(with_neighbours(batch, path)).filter("_new").orderBy("timestamp").collect()
    assert [(r["aqi"], r["aqi_change_rate"]) for r in rows] == [(110.0, 10.0)]


def test_equal_order_is_settled_by_arrival_or_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "city STRING, timestamp TIMESTAMP, aqi DOUBLE, ingest_seq BIGINT"
    for value in (90.0, 20.0):
        upsert(spark, path, spark.createDataFrame([("a", day(0), value, 1)], schema))
    assert spark.read.parquet(path).first()["aqi"] == 20.0
    with pytest.raises(ValueError, match="share"):
        upsert(spark, path, spark.createDataFrame([("a", day(0), v, 1) for v in (1.0, 2.0)], schema))


def test_scratch_is_the_session_checkpoint_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_without_a_setting_is_local_mode_only():
    from types import SimpleNamespace

    settings: dict[str, str] = {}
    conf = SimpleNamespace(get=settings.get, set=settings.__setitem__)
    context = SimpleNamespace(master="local[2]", setCheckpointDir=lambda path: None)
    fake = SimpleNamespace(conf=conf, sparkContext=context)
    root = scratch_root(fake)
    assert os.path.isdir(root) and scratch_root(fake) == root
    settings.clear()
    context.master = "yarn"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(fake)
