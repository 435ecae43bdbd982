"""Hourly series as keyed state: the latest reading of each hour beside the hour before it.

Per city the state holds the hours the watermark has not closed, and the last closed one.
A reading that changes an hour sends this hour out again, and the hour after it, whose look
back has changed; hours the watermark passes leave the state, by a timer where a city falls
silent. Whatever the cut of the deliveries, the last row sent of an hour is the row of one
run over all readings, as long as none comes later than the delay.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_HOUR = 3_600_000_000
_LEAST = -(2**63)
_READING = "city string, ts timestamp, hour bigint, rank array<bigint>, value double, payload string"
_PLACED = "city string, hour bigint, value double, previous double, payload string"
_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

Held = dict[int, list]


def _rank(df: DataFrame, column: str):
    """An order column as a whole number; a missing one comes before all."""
    kind = dict(df.dtypes)[column]
    value = F.unix_micros(F.col(column).cast("timestamp")) if kind.startswith("timestamp") else F.col(column)
    return F.coalesce(value.cast("bigint"), F.lit(_LEAST))


def _later(one: Sequence, other: Sequence) -> bool:
    """Whether a reading wins over another of its hour: by rank, equal ones by their content."""
    return (list(one[0]), one[2] or "") > (list(other[0]), other[2] or "")


def _latest(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The latest reading per city and hour of a task, so that a hot city shuffles few rows."""
    best: dict[tuple, tuple] = {}
    for frame in frames:
        for city, ts, hour, rank, value, payload in frame.itertuples(index=False, name=None):
            known = best.get((city, hour))
            if known is None or _later((rank, value, payload), known[1:]):
                best[city, hour] = (ts, rank, value, payload)
    rows = [(city, ts, hour, list(rank), value, payload) for (city, hour), (ts, rank, value, payload) in best.items()]
    yield pd.DataFrame(rows, columns=["city", "ts", "hour", "rank", "value", "payload"])


def _number(value: object) -> float | None:
    return None if value is None or value != value else float(value)


def merged(held: Held, readings: Iterable[tuple]) -> set[int]:
    """Puts ``(hour, rank, value, payload)`` readings among the held hours; the hours they change."""
    changed = set()
    for hour, rank, value, payload in readings:
        row = [[int(r) for r in rank], _number(value), payload]
        if hour not in held or _later(row, held[hour]):
            held[hour] = row
            changed.add(hour)
    return changed


def placed(held: Held, changed: set[int]) -> list[tuple]:
    """``(hour, value, previous value, payload)`` of the changed hours and those after them."""
    hours = sorted(held)
    out = []
    for i, hour in enumerate(hours):
        before = hours[i - 1] if i else None
        if hour in changed or before in changed:
            out.append((hour, held[hour][1], held[before][1] if i else None, held[hour][2]))
    return out


def without_closed(held: Held, watermark: int) -> Held:
    """The hours that may still change, and the last one that cannot."""
    closed = sorted(h for h in held if h + _HOUR <= watermark)
    return {h: row for h, row in held.items() if h not in closed[:-1]}


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held: Held = {int(h): row for h, row in json.loads(state.get[0]).items()} if state.exists else {}
    changed: set[int] = set()
    if not state.hasTimedOut:
        for frame in frames:
            readings = frame[["hour", "rank", "value", "payload"]].itertuples(index=False, name=None)
            changed |= merged(held, readings)
    rows = [(key[0], *row) for row in placed(held, changed)]
    watermark = state.getCurrentWatermarkMs()
    held = without_closed(held, watermark * 1000)
    state.update((json.dumps(held),))
    due = [h // 1000 + _HOUR // 1000 for h in held if h // 1000 + _HOUR // 1000 > watermark]
    if due:
        state.setTimeoutTimestamp(max(due))
    if rows:
        out = pd.DataFrame(rows, columns=["city", "hour", "value", "previous", "payload"])
        yield out.astype({"hour": "int64", "value": "float64", "previous": "float64"})


def hourly_with_previous(
    readings: DataFrame, order: Sequence[str], delay: str, columns: Sequence[str] = (), value: str = "aqi"
) -> DataFrame:
    """A stream of ``city, timestamp, value, previous_<value>`` and ``columns``, in update mode.

    ``readings`` has ``city`` and ``ts``; ``order`` (times or whole numbers) tells the latest
    reading of an hour. A row replaces earlier rows of its city and hour. Readings of hours
    the watermark has closed are dropped by Spark and counted in the query's progress.
    """
    hour = F.unix_micros(F.date_trunc("hour", F.col("ts").cast("timestamp")))
    narrow = readings.select(
        F.col("city").cast("string").alias("city"),
        F.timestamp_micros(hour + _HOUR - 1).alias("ts"),
        hour.alias("hour"),
        F.array(*[_rank(readings, c) for c in order]).alias("rank"),
        F.col(value).cast("double").alias("value"),
        F.to_json(F.struct(*columns), _TEXT).alias("payload") if columns else F.lit("").alias("payload"),
    )
    latest = narrow.mapInPandas(_latest, _READING).withWatermark("ts", delay)
    followed = latest.groupBy("city").applyInPandasWithState(
        _follow, _PLACED, "held string", "update", GroupStateTimeout.EventTimeTimeout
    )
    known = F.from_json("payload", readings.select(*columns).schema, _TEXT) if columns else None
    return followed.select(
        "city",
        F.timestamp_micros("hour").alias("timestamp"),
        F.col("value").alias(value),
        F.col("previous").alias(f"previous_{value}"),
        *[known.getField(c).alias(c) for c in columns],
    )
