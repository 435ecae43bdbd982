from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import day
from zephyrine.operators.projection import assemble_feature_rows
from zephyrine.operators.series import add_change_rate
from zephyrine.plans.ingest import ingest_payloads, payloads_alone
from zephyrine.schema import FEATURE_TABLE_COLUMNS
from zephyrine.streaming.hours import merged, placed, without_closed
from zephyrine.streaming.jobs import (
    event_time,
    level_changes,
    read_rejects,
    read_stream,
    run_append,
    stream_alerts,
    stream_change_rate,
    stream_daily_mean,
    stream_daily_mean_open,
    stream_dedup,
    stream_hourly_features,
    stream_payloads,
)

SCHEMA = (
    "city STRING, reading_id INT, ts TIMESTAMP, aqi DOUBLE, pm25 DOUBLE, temperature DOUBLE, "
    "humidity DOUBLE, pressure DOUBLE, wind_speed DOUBLE"
)


def reading(city, number, hour, aqi, minute=0):
    ts = day(hour // 24, hour % 24).replace(minute=minute)
    return (city, number, ts, aqi, aqi / 2, 20.0, 50.0, 1000.0, 3.0)


FIRST = [
    reading("a", 1, 0, 100.0),
    reading("a", 2, 0, 110.0, 30),
    reading("a", 3, 1, 40.0),
    reading("b", 4, 1, 300.0),
    reading("a", 5, 2, 900.0),
]
SECOND = [
    reading("a", 6, 26, 60.0),
    reading("a", 7, 27, 70.0),
    reading("b", 8, 27, 30.0),
    reading("b", 9, 52, 33.0),
]


@pytest.fixture
def arrivals(spark, tmp_path):
    """A folder that receives one batch of files per call."""
    source = str(tmp_path / "in")

    def deliver(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        return read_stream(spark, source, SCHEMA)

    return deliver


def whole(spark):
    return spark.createDataFrame(FIRST + SECOND, SCHEMA)


def hourly(spark):
    hour = F.date_trunc("hour", "ts").alias("timestamp")
    rest = [c for c in whole(spark).columns if c != "city"]
    latest = F.max_by(F.struct(*rest), F.struct("ts", "reading_id")).alias("r")
    return whole(spark).groupBy("city", hour).agg(latest).select("city", "timestamp", "r.*")


def test_hourly_features_equal_the_batch_run(spark, arrivals, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    for rows in (FIRST, SECOND):
        stream_hourly_features(arrivals(rows), table, checkpoint)
    expected = assemble_feature_rows(hourly(spark).filter("aqi <= 500"))
    got = spark.read.parquet(table).select(*FEATURE_TABLE_COLUMNS)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_change_rate_carries_state_between_runs(spark, arrivals, tmp_path):
    out, checkpoint = (str(tmp_path / n) for n in ("o", "c"))
    for rows in (FIRST, SECOND):
        stream_change_rate(arrivals(rows), out, checkpoint)
    expected = add_change_rate(hourly(spark).select("city", "timestamp", "aqi"))
    got = spark.read.parquet(out).select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_an_hour_may_be_split_over_batches(spark, arrivals, tmp_path):
    out, checkpoint = (str(tmp_path / n) for n in ("o", "c"))
    parts = ([reading("a", 1, 10, 100.0, 5)], [reading("a", 2, 10, 200.0, 50), reading("a", 3, 11, 220.0, 5)])
    for rows in parts:
        stream_change_rate(arrivals(rows), out, checkpoint)
    got = spark.read.parquet(out).orderBy("timestamp").collect()
    assert [(r["timestamp"].hour, r["aqi"], r["aqi_change_rate"]) for r in got] == [(10, 200.0, 0.0), (11, 220.0, 10.0)]


def test_a_late_older_reading_changes_nothing_after_it(spark, arrivals, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    parts = ([reading("a", 1, 10, 100.0, 55)], [reading("a", 2, 10, 50.0, 20), reading("a", 3, 11, 110.0, 5)])
    for rows in parts:
        stream_hourly_features(arrivals(rows), table, checkpoint)
    got = spark.read.parquet(table).orderBy("timestamp").collect()
    assert [(r["aqi"], r["aqi_change_rate"]) for r in got] == [(100.0, 0.0), (110.0, 10.0)]


def test_the_hour_after_a_late_one_is_rated_again(spark, arrivals, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    parts = ([reading("a", 1, 9, 50.0), reading("a", 2, 60, 110.0)], [reading("a", 3, 30, 100.0)])
    for rows in parts:
        stream_hourly_features(arrivals(rows), table, checkpoint)
    got = spark.read.parquet(table).orderBy("timestamp").collect()
    assert [r["aqi_change_rate"] for r in got] == [0.0, 100.0, 10.0]


def test_the_latest_valid_reading_counts_however_hours_are_cut(spark, arrivals, tmp_path):
    """A later reading outside the guard neither hides nor removes a valid one."""
    rows = [reading("a", 1, 5, 100.0, 10), reading("a", 2, 5, 900.0, 40), reading("a", 3, 6, 150.0, 5)]
    found = []
    for name, cuts in (("whole", [rows]), ("cut", [rows[:1], rows[1:2], rows[2:]])):
        folder = str(tmp_path / name)
        for part in cuts:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}-in")
            readings = read_stream(spark, f"{folder}-in", SCHEMA)
            stream_hourly_features(readings, folder, f"{folder}-c", rejects=f"{folder}-r")
        kept = spark.read.parquet(folder).orderBy("timestamp").collect()
        found.append([(r["timestamp"].hour, r["aqi"], r["aqi_change_rate"]) for r in kept])
        assert [r["reading_id"] for r in spark.read.parquet(f"{folder}-r").collect()] == [2]
    assert found[0] == found[1] == [(5, 100.0, 0.0), (6, 150.0, 50.0)]


def test_readings_behind_the_watermark_are_counted(spark, arrivals, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    parts = [[reading("a", 1, 10, 50.0), reading("a", 2, 100, 60.0)], [reading("a", 3, 101, 61.0)],
             [reading("a", 4, 11, 70.0), reading("a", 5, 99, 90.0)]]
    late = [stream_change_rate(arrivals(part), table, checkpoint, delay="5 hours") for part in parts]
    assert late == [0, 0, 1]
    rows = spark.read.parquet(table).orderBy("timestamp").collect()
    assert [(r["aqi"], r["aqi_change_rate"]) for r in rows] == [
        (50.0, 0.0), (90.0, 80.0), (60.0, -33.3333), (61.0, 1.6667),
    ]


def test_closed_hours_leave_the_state():
    held = {h * 3_600_000_000: [[h], float(h), ""] for h in (1, 2, 3, 7, 8)}
    kept = without_closed(held, 5 * 3_600_000_000)
    assert [h // 3_600_000_000 for h in kept] == [3, 7, 8]
    assert without_closed(kept, 0) == kept and without_closed({}, 10**18) == {}
    changed = merged(kept, [(7 * 3_600_000_000, [6], 1.0, ""), (4 * 3_600_000_000, [4], float("nan"), "x")])
    assert [h // 3_600_000_000 for h in changed] == [4]  # an older reading changes nothing
    assert [(h // 3_600_000_000, v, p) for h, v, p, _ in placed(kept, changed)] == [(4, None, 3.0), (7, 7.0, None)]


def payload_lines(path, rows):
    path.mkdir(exist_ok=True)
    name = f"{len(list(path.iterdir())):04d}.json"
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def air(city, hour, aqi, seq, minute=0):
    stamp = day(hour // 24, hour % 24).replace(minute=minute).isoformat()
    return {"city": city, "fetched_at": stamp, "ingest_seq": seq, "status": "ok", "data": {"aqi": aqi, "iaqi": {}}}


def weather(city, hour, seq, temp=20.0):
    stamp = day(hour // 24, hour % 24).isoformat()
    return {
        "city": city, "fetched_at": stamp, "ingest_seq": seq, "main": {"temp": temp, "humidity": 50, "pressure": 1000},
        "wind": {"speed": 3.0}, "weather": [{"description": "clear"}],
    }


AIR = [air("a", 1, 100, 1), air("b", 2, 80, 2), air("a", 2, 150, 3), air("a", 2, 120, 4, 30), air("c", 3, 40, 5),
       air("a", 60, 90, 6), air("b", 60, 900, 7)]
WEATHER = [weather("a", 1, 1), weather("b", 2, 2, 5.0), weather("a", 2, 3), weather("d", 1, 4), weather("a", 60, 5),
           weather("b", 60, 6), weather("x", 61, 7, -95.0)]
STORED = [("a", 1, 100.0, 0.0), ("a", 2, 120.0, 20.0), ("a", 60, 90.0, -25.0), ("b", 2, 80.0, 0.0)]


def stored_hours(spark, table):
    rows = spark.read.parquet(table).collect()
    return sorted(
        (r["city"], int((r["timestamp"].replace(tzinfo=None) - day(0).replace(tzinfo=None)).total_seconds() // 3600),
         r["aqi"], r["aqi_change_rate"])
        for r in rows
    )


# Air first for one city and weather first for another; partners in different deliveries.
CUTS = [[(AIR, WEATHER)], [(AIR[:1], WEATHER[1:2]), (AIR[1:4], WEATHER[:1]), (AIR[4:], WEATHER[2:])]]


@pytest.mark.parametrize("cuts", CUTS)
def test_payloads_meet_across_deliveries(spark, tmp_path, cuts):
    names = ("air", "weather", "table", "state", "rejects")
    a, w, table, state, rejects = (tmp_path / n for n in names)
    for airs, weathers in cuts:
        payload_lines(a, airs)
        payload_lines(w, weathers)
        late = stream_payloads(spark, *(str(p) for p in (a, w, table, state, rejects)))
    assert late == 0 and stored_hours(spark, str(table)) == STORED
    found = sorted((r["source"], r["reason"]) for r in read_rejects(spark, str(rejects)).collect())
    outside = "outside the ingest rules"
    assert found == [
        ("aqi", "no weather of the hour"), ("aqi", outside), ("weather", "no air reading of the hour"), ("weather", outside),
    ]


def test_many_payloads_of_one_hour_are_not_joined_in_pairs(spark, tmp_path):
    """120 by 120 payloads of an hour in two deliveries leave few rows; all of an hour alone are told."""
    a, w, table, state, rejects = (tmp_path / n for n in ("air", "weather", "table", "state", "rejects"))
    payload_lines(a, [air("a", 1, k % 50, k, k % 60) for k in range(120)] + [air("c", 1, 5, k) for k in range(70)])
    payload_lines(w, [weather("a", 1, k, k / 10) for k in range(60)])
    last = [weather("a", 1, k, k / 10) for k in range(60, 120)] + [weather("d", 2, k) for k in range(80)]
    names = [str(p) for p in (a, w, table, state, rejects)]
    assert stream_payloads(spark, *names) == 0
    payload_lines(a, [air("a", 60, 90, 500), air("a", 61, 90, 501)])
    payload_lines(w, [*last, weather("a", 60, 500), weather("a", 61, 501)])
    assert stream_payloads(spark, *names) == 0
    assert spark.read.parquet(f"{state}/*/*.parquet").count() < 100
    rows = {r["timestamp"].hour: (r["aqi"], r["temperature"]) for r in spark.read.parquet(str(table)).collect()}
    assert rows[1] == (119 % 50, 11.9)
    told = read_rejects(spark, str(rejects)).groupBy("source", "reason").count().collect()
    assert {(r["source"], r["count"]) for r in told} == {("aqi", 70), ("weather", 80)}
    row = json.loads(read_rejects(spark, str(rejects)).filter("source = 'weather'").first()["row"])
    assert row["city"] == "d" and "weather_fetched_at" in row and row["temperature"] == 20.0
    payload_lines(a, [air("a", 1, 7, 900), air("a", 70, 7, 901)])
    payload_lines(w, [weather("b", 1, 900)])
    assert stream_payloads(spark, *names) == 2  # both of the closed hour 1, once each
    assert len(stored_hours(spark, str(table))) == 3


@pytest.mark.parametrize("cuts", CUTS)
def test_ingest_keeps_payloads_without_a_partner(spark, tmp_path, cuts):
    table = str(tmp_path / "table")
    for seq, (airs, weathers) in enumerate(cuts, 1):
        a, w = tmp_path / f"a{seq}", tmp_path / f"w{seq}"
        payload_lines(a, airs)
        payload_lines(w, weathers)
        for _ in range(2):  # a run that is repeated changes nothing
            ingest_payloads(spark, str(a), str(w), table, seq, str(tmp_path / "rejects"))
    assert stored_hours(spark, table) == STORED
    alone = {(r["side"], r["city"]) for r in payloads_alone(spark, table).collect()}
    assert alone == {("aqi", "c"), ("weather", "d"), ("weather", "b")}


def test_a_delivery_of_one_row_takes_few_jobs(spark, arrivals, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    stream_change_rate(arrivals([reading("a", 1, 10, 50.0)]), table, checkpoint)
    readings = arrivals([reading("a", 2, 11, 60.0)])
    before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    stream_change_rate(readings, table, checkpoint)
    assert spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() - before < 10
    assert spark.read.parquet(table).count() == 2


def test_alerts_only_on_level_changes(spark, arrivals, tmp_path):
    out, checkpoint = (str(tmp_path / n) for n in ("o", "c"))
    for rows in (FIRST, SECOND):
        stream_alerts(arrivals(rows), out, checkpoint)
    rows = level_changes(spark.read.parquet(out)).collect()
    assert {(r["city"], r["level"], r["previous_level"]) for r in rows} == {
        ("a", "unhealthy_sensitive", None),
        ("a", "good", "unhealthy_sensitive"),
        ("a", "hazardous", "good"),
        ("a", "moderate", "hazardous"),
        ("b", "very_unhealthy", None),
        ("b", "good", "very_unhealthy"),
    }


def test_a_level_within_a_split_hour_is_told_once(spark, arrivals, tmp_path):
    out, checkpoint = (str(tmp_path / n) for n in ("o", "c"))
    parts = ([reading("a", 1, 10, 40.0, 5)], [reading("a", 2, 10, 120.0, 50), reading("a", 3, 11, 130.0, 5)])
    for rows in parts:
        stream_alerts(arrivals(rows), out, checkpoint)
    rows = level_changes(spark.read.parquet(out)).collect()
    assert [(r["level"], r["previous_level"]) for r in rows] == [("unhealthy_sensitive", None)]


def test_dedup_keeps_the_first_arrival(spark, arrivals, tmp_path):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for rows in (FIRST[:3], [reading("a", 99, 1, 41.0)] + SECOND):
        stream_dedup(arrivals(rows), out, checkpoint, ["city", "ts"], "3 days")
    got = sorted(r["reading_id"] for r in spark.read.parquet(out).collect())
    assert got == [1, 2, 3, 6, 7, 8, 9]


def test_daily_mean_emits_closed_days_only(spark, arrivals, tmp_path):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for rows in (FIRST, SECOND):
        stream_daily_mean(arrivals(rows), out, checkpoint)
    got = {(r["city"], r["day"].day): r["pm25"] for r in spark.read.parquet(out).collect()}
    assert got == {("a", 1): 143.75, ("b", 1): 150.0, ("a", 2): 32.5, ("b", 2): 15.0}


def test_open_days_are_stored_and_replaced(spark, arrivals, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    for rows in (FIRST, SECOND):
        stream_daily_mean_open(arrivals(rows), table, checkpoint, "3 days")
    got = {(r["city"], r["day"].day): r["pm25"] for r in spark.read.parquet(table).collect()}
    assert got == {("a", 1): 143.75, ("b", 1): 150.0, ("a", 2): 32.5, ("b", 2): 15.0, ("b", 3): 16.5}


def test_a_rerun_reads_only_new_files(spark, arrivals, tmp_path):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    run_append(arrivals(FIRST).select("reading_id"), checkpoint, out)
    run_append(read_stream(spark, str(tmp_path / "in"), SCHEMA).select("reading_id"), checkpoint, out)
    assert spark.read.parquet(out).count() == len(FIRST)
    run_append(arrivals(SECOND).select("reading_id"), checkpoint, out)
    assert spark.read.parquet(out).count() == len(FIRST) + len(SECOND)


def test_event_time_accepts_zoneless_timestamps(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2026-01-01 00:00:00' AS ts")
    assert dict(event_time(rows).dtypes)["ts"] == "timestamp"
