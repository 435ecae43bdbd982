"""The streamed backfill stores the same table however the measurements are cut."""

from __future__ import annotations

import datetime as dt

from zephyrine.plans.ingest import backfill_delivery
from zephyrine.sources.store import load_processed_dates
from zephyrine.streaming.jobs import read_stream, stream_backfill

SCHEMA = "city STRING, day DATE, value DOUBLE"
ONE, TWO, THREE = (dt.date(2024, 3, d) for d in (1, 2, 3))
ROWS = [
    ("a", ONE, 10.0), ("b", TWO, 40.0), ("a", TWO, 20.0), ("a", ONE, 30.0), ("b", ONE, -1.0),
    ("a", TWO, None), ("b", TWO, 50.0), ("b", ONE, 8.0), ("a", THREE, 5.0), ("b", THREE, -1.0),
]


def stored(spark, folder, cuts):
    source, table, done = (str(folder / name) for name in ("in", "table", "done"))
    for rows in cuts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream_backfill(read_stream(spark, source, SCHEMA), table, done, str(folder / "checkpoint"))
    found = spark.read.parquet(table).drop("ingest_seq", "event_date")
    return sorted(map(tuple, found.select(sorted(found.columns)).collect()), key=repr), table, done


def test_the_table_does_not_depend_on_the_cuts(spark, tmp_path):
    whole, table, _ = stored(spark, tmp_path / "whole", [ROWS])
    cut, _, done = stored(spark, tmp_path / "cut", [ROWS[:2], ROWS[2:5], ROWS[5:]])
    assert cut == whole and len(whole) == 5
    means = {(r["city"], r["event_date"]): r["pm25"] for r in spark.read.parquet(table).collect()}
    assert means == {("a", ONE): 20.0, ("a", TWO): 20.0, ("a", THREE): 5.0, ("b", ONE): 8.0, ("b", TWO): 45.0}
    assert load_processed_dates(spark, done, by_city=True).count() == 6


def test_a_delivery_that_runs_again_counts_once(spark, tmp_path):
    table, done = str(tmp_path / "table"), str(tmp_path / "done")
    for seq, rows in ((0, ROWS[:4]), (1, ROWS[4:]), (1, ROWS[4:])):
        backfill_delivery(spark, spark.createDataFrame(rows, SCHEMA), table, done, seq)
    found = {(r["city"], r["event_date"].day): r["pm25"] for r in spark.read.parquet(table).collect()}
    assert found[("b", 2)] == 45.0 and found[("a", 1)] == 20.0 and found[("b", 1)] == 8.0
