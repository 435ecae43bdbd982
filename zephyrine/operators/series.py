"""Resampling, lags, rolling statistics and targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from zephyrine.functions.numeric import change_rate, exact_parts, joined_parts
from zephyrine.operators.blocks import over_series
from zephyrine.schema import LAG_INPUT_COLUMNS
from zephyrine.sources.tables import latest_rows

# Lags and rolling widths, in rows.
DAILY_LAGS = [1, 2, 3, 7, 14]
DAILY_MEANS = [3, 7, 14]
DAILY_STD = 7
WEATHER_MEAN = 3
TARGET_STEPS = [1, 2, 3]
HOURLY_LAGS = [1, 6, 24, 48, 72]
HOURLY_MEANS = [6, 24, 168]
HOURLY_STD = 24
PM25_HOURLY_LAGS = [1, 24]
WIND_HOURLY_LAGS = [1]


def resample_latest(
    df: DataFrame,
    keys: Sequence[str],
    grain: str,
    order: Sequence[str],
    time_column: str = "timestamp",
    slot: str = "slot",
) -> DataFrame:
    """Latest reading per key and calendar slot (``day``, ``hour``), stamped in ``slot``.

    A partial aggregate: a hot key is reduced to one row per slot before the shuffle.
    """
    slotted = df.withColumn(slot, F.date_trunc(grain, F.col(time_column)))
    return latest_rows(slotted, [*keys, slot], order)


def _previous(window: WindowSpec, rows: int) -> WindowSpec:
    """The ``rows`` rows before the current one; the current row never counts."""
    return window.rowsBetween(-rows, -1)


def daily_lags(window: WindowSpec, lookback_days: int = 14) -> dict[str, Column]:
    return {
        f"aqi_lag_{k}d": F.lag("aqi", k).over(window) for k in DAILY_LAGS if k <= lookback_days
    }


def rolling_means(window: WindowSpec) -> dict[str, Column]:
    """Mean of the non-missing values among the previous n rows."""
    return {
        f"aqi_rolling_mean_{n}d": F.avg("aqi").over(_previous(window, n)) for n in DAILY_MEANS
    }


def rolling_std(window: WindowSpec) -> dict[str, Column]:
    """Sample deviation of the previous 7 rows; fewer than two values give 0."""
    spread = F.stddev_samp("aqi").over(_previous(window, DAILY_STD))
    return {f"aqi_rolling_std_{DAILY_STD}d": F.coalesce(spread, F.lit(0.0))}


def weather_rolling(window: WindowSpec) -> dict[str, Column]:
    frame = _previous(window, WEATHER_MEAN)
    return {
        f"temp_rolling_mean_{WEATHER_MEAN}d": F.avg("temperature").over(frame),
        f"humidity_rolling_mean_{WEATHER_MEAN}d": F.avg("humidity").over(frame),
    }


def targets(window: WindowSpec) -> dict[str, Column]:
    return {f"target_aqi_{k}d": F.lead("aqi", k).over(window) for k in TARGET_STEPS}


def add_daily_lag_features(
    df: DataFrame,
    lookback_days: int = 14,
    keys: Sequence[str] = ("city",),
    order: Sequence[str] = ("timestamp",),
    drop: bool = True,
    block_rows: int | None = None,
) -> DataFrame:
    """All daily features in one exchange and one sort.

    ``drop`` removes rows without a first lag, a 7-row mean or a next-row target;
    the 2- and 3-row targets may stay missing.
    """
    missing = sorted(set(LAG_INPUT_COLUMNS).difference(df.columns))
    if missing:
        raise ValueError(f"lags need the columns {missing}")

    def columns(window: WindowSpec) -> dict[str, Column]:
        return {
            **daily_lags(window, lookback_days),
            **rolling_means(window),
            **rolling_std(window),
            **weather_rolling(window),
            **targets(window),
        }

    out = over_series(
        df, keys, order, columns, back=max(DAILY_LAGS), ahead=max(TARGET_STEPS), block_rows=block_rows
    )
    if drop:
        out = out.dropna(subset=["aqi_lag_1d", "aqi_rolling_mean_7d", "target_aqi_1d"])
    return out


def _full_window(column: str, statistic: Column, window: WindowSpec, rows: int) -> Column:
    """The statistic only where all of the previous n values are present."""
    frame = _previous(window, rows)
    return F.when(F.count(column).over(frame) == rows, statistic.over(frame))


def _prefix_mean(column: str, window: WindowSpec, rows: int) -> Column:
    """Mean of the previous n values where all are present, from running sums: the sum of all
    rows before minus that of the rows n before those. Whole-number sums lose nothing."""

    def until(end: int) -> tuple[Column, Column, Column]:
        frame = window.rowsBetween(Window.unboundedPreceding, end)
        totals = [F.coalesce(F.sum(part).over(frame), F.lit(0)) for part in exact_parts(F.col(column))]
        return *totals, F.count(column).over(frame)

    now, before = until(-1), until(-rows - 1)
    coarse, fine, count = (a - b for a, b in zip(now, before))
    return F.when(count == rows, joined_parts(coarse, fine) / F.lit(float(rows)))


def hourly_lags(window: WindowSpec) -> dict[str, Column]:
    return {f"aqi_lag_{k}h": F.lag("aqi", k).over(window) for k in HOURLY_LAGS}


def hourly_rolling(window: WindowSpec) -> dict[str, Column]:
    out = {
        f"aqi_rolling_mean_{n}h": _prefix_mean("aqi", window, n) for n in HOURLY_MEANS
    }
    out[f"aqi_rolling_std_{HOURLY_STD}h"] = _full_window(
        "aqi", F.stddev_samp("aqi"), window, HOURLY_STD
    )
    return out


def optional_hourly_lags(window: WindowSpec, columns: Sequence[str]) -> dict[str, Column]:
    """PM2.5 and wind lags, for the columns the frame has."""
    out: dict[str, Column] = {}
    if "pm25" in columns:
        out |= {f"pm25_lag_{k}h": F.lag("pm25", k).over(window) for k in PM25_HOURLY_LAGS}
    if "wind_speed" in columns:
        out |= {f"wind_lag_{k}h": F.lag("wind_speed", k).over(window) for k in WIND_HOURLY_LAGS}
    return out


def add_hourly_lag_features(
    df: DataFrame,
    keys: Sequence[str] = ("city",),
    order: Sequence[str] = ("timestamp",),
    block_rows: int | None = None,
) -> DataFrame:
    def columns(window: WindowSpec) -> dict[str, Column]:
        return {
            **hourly_lags(window),
            **hourly_rolling(window),
            **optional_hourly_lags(window, df.columns),
        }

    return over_series(df, keys, order, columns, back=max(HOURLY_MEANS), block_rows=block_rows)


def latest_inference_rows(
    df: DataFrame,
    feature_columns: Sequence[str] | None = None,
    keys: Sequence[str] = ("city",),
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Last row per series that has a 72-row lag, aligned to the model's columns.

    The wide frames run only over the rows that row can see, not over the whole history;
    both window passes share one exchange and one sort.
    """
    from zephyrine.operators.projection import align_columns

    series = Window.partitionBy(*keys)
    ordered = series.orderBy(*order)
    usable = F.lag("aqi", max(HOURLY_LAGS)).over(ordered).isNotNull()
    place = F.row_number().over(ordered)
    placed = df.withColumns({"_place": place, "_usable": usable})
    last = F.max(F.when(F.col("_usable"), F.col("_place"))).over(series)
    reach = F.col("_last") - F.col("_place")
    near = placed.withColumn("_last", last).filter(reach.between(0, max(HOURLY_MEANS)))
    lagged = add_hourly_lag_features(near.drop("_usable"), keys, order)
    latest = lagged.filter(F.col("_place") == F.col("_last")).drop("_place", "_last")
    if feature_columns is None:
        return latest
    identity = [*keys, *[c for c in order if c not in keys]]
    return align_columns(latest, feature_columns, keep=identity)


def add_change_rate(
    df: DataFrame,
    keys: Sequence[str] = ("city",),
    order: Sequence[str] = ("timestamp",),
    block_rows: int | None = None,
) -> DataFrame:
    """Percent change against the previous reading of the series."""

    def columns(window: WindowSpec) -> dict[str, Column]:
        return {"aqi_change_rate": change_rate(F.col("aqi"), F.lag("aqi", 1).over(window))}

    return over_series(df, keys, order, columns, back=1, block_rows=block_rows)


def calendar_lag(
    df: DataFrame,
    days: int,
    keys: Sequence[str] = ("city",),
    time_column: str = "timestamp",
    name: str | None = None,
) -> DataFrame:
    """Index of the last reading in the 24 hours that end ``days`` days before each row.

    For tables mixing hourly and daily rows, where a row shift is not a time shift.
    Timestamps must be unique within a series. The window runs per series and calendar day:
    a day's rows meet only the readings of the two days their frames reach into, so a series
    of any length spreads over its days.
    """
    if days < 1:
        raise ValueError("a calendar lag goes back one day at least")
    name = name or f"aqi_calendar_lag_{days}d"
    micros = 86_400_000_000
    seconds = F.unix_micros(F.col(time_column))
    day = F.floor(seconds / F.lit(micros)).cast("bigint")
    own = df.withColumns({"_day": day, "_home": F.lit(True)})
    reached = df.select(*keys, time_column, "aqi").withColumn(
        "_day", F.explode(F.array(day + days, day + days + 1))
    )
    both = own.unionByName(reached.withColumn("_home", F.lit(False)), allowMissingColumns=True)
    frame = Window.partitionBy(*keys, "_day").orderBy(F.unix_micros(F.col(time_column))).rangeBetween(
        -(days + 1) * micros + 1, -days * micros
    )
    lagged = both.withColumn(name, F.last("aqi").over(frame))
    return lagged.filter("_home").select(*df.columns, name)
