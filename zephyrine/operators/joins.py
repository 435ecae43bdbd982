"""Joins between readings, dimensions and date spines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from zephyrine.functions.calendar import date_spine, floor_hour
from zephyrine.functions.numeric import change_rate, half_even
from zephyrine.functions.weather import approximate_weather, climatology
from zephyrine.operators.blocks import over_series, written_slices
from zephyrine.operators.quality import filter_valid_measurements
from zephyrine.schema import AQI_CAP, PM25_BREAKPOINTS, PM25_CAP
from zephyrine.session import scratch_path
from zephyrine.sources.store import DATE_COLUMN, SEQ_COLUMN, latest_per_key, read_table, stored_cities

CLIMATE_COLUMNS = ["temperature", "humidity", "wind_speed", "pressure"]


def with_climatology(df: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """Adds the ``clim_*`` columns of the row's month (12-row broadcast)."""
    months = F.broadcast(climatology(df.sparkSession))
    return df.join(months, F.month(F.col(time_column)) == months["month"], "left").drop(
        months["month"]
    )


def climatology_join(
    df: DataFrame, time_column: str = "timestamp", jitter_key: Column | None = None
) -> DataFrame:
    """Sets the weather columns from the month; with ``jitter_key`` adds keyed noise."""
    joined = with_climatology(df, time_column)
    if jitter_key is not None:
        weather = approximate_weather(jitter_key)
    else:
        weather = {c: F.col(f"clim_{c}") for c in CLIMATE_COLUMNS}
    return joined.withColumns(weather).drop(*[f"clim_{c}" for c in CLIMATE_COLUMNS])


def days_between(spark: SparkSession, bounds: DataFrame) -> DataFrame:
    """Every day from ``first_day`` to ``last_day`` of a one-row frame, inclusive."""
    spine = date_spine(F.col("first_day"), F.col("last_day"))
    return bounds.select(F.explode(spine).alias("day"))


def pending_dates(spine: DataFrame, processed: DataFrame) -> DataFrame:
    return spine.join(processed.select("day").distinct(), "day", "left_anti")


def day_status(
    spine: DataFrame,
    processed: DataFrame,
    measurements: DataFrame,
    value: str = "value",
    keys: Sequence[str] = ("day",),
) -> DataFrame:
    """Status per day (or per other ``keys``): ``skipped`` if already done, ``failed`` without
    a valid measurement, else ``pushed``."""
    keys = list(keys)
    done = processed.select(*keys).distinct().withColumn("_done", F.lit(True))
    valid = filter_valid_measurements(measurements, value)
    seen = valid.groupBy(*keys).agg(F.count("*").alias("measurements"))
    status = (
        F.when(F.col("_done"), F.lit("skipped"))
        .when(F.col("measurements").isNull(), F.lit("failed"))
        .otherwise(F.lit("pushed"))
    )
    return (
        spine.join(done, keys, "left")
        .join(seen, keys, "left")
        .select(*keys, status.alias("status"), F.coalesce("measurements", F.lit(0)).alias("measurements"))
    )


def dates_without_data(
    spine: DataFrame, measurements: DataFrame, value: str = "value"
) -> DataFrame:
    valid = filter_valid_measurements(measurements, value)
    return spine.join(valid.select("day").distinct(), "day", "left_anti")


def combine_sources(aqi: DataFrame, weather: DataFrame) -> DataFrame:
    """AQI and weather of the same city and hour, each side latest-wins first.

    Both sides are unique on the join key, so no key can multiply rows.
    """

    def hourly(df: DataFrame) -> DataFrame:
        stamped = df.withColumn("timestamp", floor_hour(F.col("fetched_at")))
        return latest_per_key(stamped, order=["fetched_at", "ingest_seq"])

    right = hourly(weather).drop("fetched_at", "ingest_seq")
    return hourly(aqi).join(right, ["city", "timestamp"])


def segment_join(
    df: DataFrame, segments: DataFrame, column: str, low: str = "c_low", high: str = "c_high"
) -> DataFrame:
    """Every row with the segment its value lies in, both ends included, or NULLs.

    Segments must not overlap; where two touch, the one that begins at the value counts. Rows
    and segments are put in one order, written as range-partitioned slices that split even
    equal values, and each row takes the last segment that begins at or before its value: in
    its slice, or the last one of the slices before, of which there is one row per slice.
    There is no nested loop, whatever the number of segments. Segments with a NULL end match
    nothing; names of segment columns must not occur in ``df``.
    """
    segment = F.struct(*[F.col(f"`{c}`") for c in segments.columns])
    kept = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    begins = segments.filter(F.col(low).isNotNull() & F.col(high).isNotNull()).select(
        F.col(low).cast("double").alias("_value"), F.lit(0).alias("_kind"), segment.alias("_segment")
    )
    rows = df.select(F.col(column).cast("double").alias("_value"), F.lit(1).alias("_kind"), kept.alias("_row_of"))
    both = begins.unionByName(rows, allowMissingColumns=True)
    both = both.withColumn("_tie", F.monotonically_increasing_id())
    slices = written_slices(both, [], ["_value", "_kind", "_tie"])
    ends = slices.filter("_kind = 0").groupBy("_slice").agg(F.max_by("_segment", "_row").alias("_last"))
    every = slices.groupBy("_slice").count().join(ends.withColumnRenamed("_slice", "_of"), F.col("_slice") == F.col("_of"), "left")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    carried = every.select(
        F.col("_slice").alias("_of"), F.last("_last", ignorenulls=True).over(before).alias("_carried")
    )
    seen = Window.partitionBy("_slice").orderBy("_row")
    own = F.last("_segment", ignorenulls=True).over(seen)
    met = slices.withColumn("_own", own).filter("_kind = 1")
    placed = met.join(F.broadcast(carried), F.col("_slice") == F.col("_of"))
    found = placed.select("_value", "_row_of", F.coalesce("_own", "_carried").alias("_found"))
    inside = F.col("_value") <= F.col(f"_found.{high}")
    return found.select(
        "_row_of.*", *[F.when(inside, F.col(f"_found.`{c}`")).alias(c) for c in segments.columns]
    )


def breakpoint_join(df: DataFrame, breakpoints: DataFrame | None = None, column: str = "pm25") -> DataFrame:
    """Index from a breakpoint table.

    ``breakpoints`` has ``c_low, c_high, i_low, i_high``, any number of segments that do not
    overlap, and is met by ``segment_join``; without one the fixed seven are broadcast.
    ``pm25_to_aqi`` is the expression form of the fixed table and the default.
    """
    level = F.least(F.col(column), F.lit(PM25_CAP))
    leveled = df.withColumn("_level", level)
    if breakpoints is None:
        fixed = df.sparkSession.createDataFrame(
            [tuple(map(float, row)) for row in PM25_BREAKPOINTS],
            "c_low DOUBLE, c_high DOUBLE, i_low DOUBLE, i_high DOUBLE",
        )
        inside = F.col("_level").between(F.col("c_low"), F.col("c_high"))
        joined = leveled.join(F.broadcast(fixed), inside, "left")
    else:
        joined = segment_join(leveled, breakpoints.select("c_low", "c_high", "i_low", "i_high"), "_level")
    slope = (F.col("i_high") - F.col("i_low")) / (F.col("c_high") - F.col("c_low"))
    value = half_even(slope * (F.col("_level") - F.col("c_low")) + F.col("i_low"), 1)
    return joined.withColumn("aqi", F.coalesce(value, F.lit(AQI_CAP))).drop(
        "_level", "c_low", "c_high", "i_low", "i_high"
    )


def previous_reading(
    history: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = ("city",),
    order: Sequence[str] = ("timestamp",),
    block_rows: int | None = None,
) -> DataFrame:
    """For each batch row the index just before it in history and batch together.

    A row arriving late is compared with its own past, not with the newest reading.
    """
    columns = list(dict.fromkeys([*keys, *order, "aqi"]))
    both = history.select(*columns, F.lit(False).alias("_new")).unionByName(
        batch.select(*columns, F.lit(True).alias("_new"))
    )

    def previous(window: WindowSpec) -> dict[str, Column]:
        return {"previous_aqi": F.lag("aqi", 1).over(window)}

    placed = over_series(both, keys, order, previous, back=1, block_rows=block_rows)
    return placed.filter("_new").drop("_new").withColumn(
        "aqi_change_rate", change_rate(F.col("aqi"), F.col("previous_aqi"))
    )


def _nearest(
    spark: SparkSession, table: DataFrame, wanted: DataFrame, edge: dt.date, ahead: bool
) -> DataFrame | None:
    """``city, timestamp, aqi``: per (city, day) of ``wanted`` the nearest stored row beyond it.

    Reads the next stored dates first and goes twice as far each time, only for pairs without
    a row so far, up to ``edge``, the furthest stored date.
    """
    step, reach = (1, 1) if ahead else (-1, 1)
    found: DataFrame | None = None
    offset = 1
    while True:
        days = [r["day"] for r in wanted.select("day").distinct().collect()]  # days of a batch
        spans = [range(offset, offset + reach)] if days else []
        dates = sorted({d + dt.timedelta(days=step * k) for d in days for span in spans for k in span})
        dates = [d for d in dates if (d <= edge if ahead else d >= edge)]
        if not dates:
            return found
        gap = F.datediff(F.col(DATE_COLUMN), F.col("day")) * step
        rows = table.filter(F.col(DATE_COLUMN).isin(dates)).select("city", "timestamp", "aqi", DATE_COLUMN)
        near = rows.join(wanted, "city").filter(gap.between(offset, offset + reach - 1))
        pick = F.min_by if ahead else F.max_by
        best = near.groupBy("city", "day").agg(
            pick(F.struct("timestamp", "aqi"), "timestamp").alias("row")
        )
        path = scratch_path(spark, "neighbours")
        best.select("city", "day", "row.*").write.parquet(path)
        best = spark.read.parquet(path)
        found = best if found is None else found.unionByName(best)
        wanted = wanted.join(best.select("city", "day"), ["city", "day"], "left_anti")
        offset, reach = offset + reach, reach * 2


def with_neighbours(
    batch: DataFrame,
    path: str,
    order: Sequence[str] = (SEQ_COLUMN,),
) -> DataFrame:
    """The rows to store again after ``batch`` arrives, amid the rows their look-back reaches.

    Stored rows of the batch's days and the batch are merged first, the latest by ``order``
    winning. Rows to store (``_new``) are those of the batch that won and, since their
    predecessor may have changed, the rows right after a batch row. Beyond the batch's days
    only the nearest stored row of a city on either side is looked up, over dates its city
    has; a batch at the end of the table reads its own and the last date before it.

    ``batch`` must have one row per (city, timestamp). Other columns of looked-up rows are
    NULL, except those of rows to store, which are read whole.
    """
    spark = batch.sparkSession
    stored, cities = read_table(spark, path), stored_cities(spark, path)
    if stored is None or cities is None:
        return batch.withColumn("_new", F.lit(True))
    dated = batch.withColumn(DATE_COLUMN, F.to_date("timestamp"))
    # One value per calendar day of the batch.
    days = sorted(r[0] for r in dated.select(DATE_COLUMN).distinct().collect() if r[0] is not None)
    if not days:
        return batch.withColumn("_new", F.lit(True))
    columns = [c for c in batch.columns if c in stored.columns]
    own = stored.filter(F.col(DATE_COLUMN).isin(days)).select(*columns, F.lit(False).alias("_batch"))
    merged = latest_per_key(
        own.unionByName(batch.select(*columns, F.lit(True).alias("_batch"))), order=[*order, "_batch"]
    )
    merged_path = scratch_path(spark, "merged")
    merged.write.parquet(merged_path)
    merged = spark.read.parquet(merged_path)

    pairs = dated.select("city", F.col(DATE_COLUMN).alias("day")).distinct()
    bounded = pairs.join(cities, "city")
    loaded = merged.select("city", F.to_date("timestamp").alias("day")).distinct()

    def beyond(ahead: bool) -> DataFrame | None:
        next_to = loaded.select("city", F.date_add("day", -1 if ahead else 1).alias("day"))
        side = F.col("last_day") > F.col("day") if ahead else F.col("first_day") < F.col("day")
        wanted = bounded.filter(side).join(next_to, ["city", "day"], "left_anti").select("city", "day")
        edge = cities.agg(F.max("last_day") if ahead else F.min("first_day")).first()[0]
        path_wanted = scratch_path(spark, "wanted")
        wanted.write.parquet(path_wanted)
        others = stored.filter(~F.col(DATE_COLUMN).isin(days))
        return _nearest(spark, others, spark.read.parquet(path_wanted), edge, ahead)

    before, after = beyond(False), beyond(True)
    rows = merged.withColumn("_context", F.lit(False))
    keyed = ["city", "timestamp"]
    for side in (before, after):
        if side is not None:
            near = side.select("city", "timestamp").distinct()
            if side is after:
                dates = [r[0] for r in near.select(F.to_date("timestamp")).distinct().collect()]
                full = stored.filter(F.col(DATE_COLUMN).isin(dates)).select(*columns)
                near = full.join(near, keyed, "left_semi")
            else:
                near = side.select("city", "timestamp", "aqi").distinct()
            near = near.withColumns({"_batch": F.lit(False), "_context": F.lit(True)})
            rows = rows.unionByName(near, allowMissingColumns=True)
    # A row may be looked up from both sides; its whole form is kept.
    rows = rows.groupBy(*keyed).agg(
        F.max_by(
            F.struct(*[c for c in rows.columns if c not in keyed]),
            F.struct(~F.col("_context"), *[F.col(o).isNotNull() for o in order]),
        ).alias("_row")
    ).select(*keyed, "_row.*")
    previous = F.lag("_batch").over(Window.partitionBy("city").orderBy("timestamp"))
    marked = rows.withColumn("_new", F.col("_batch") | F.coalesce(previous, F.lit(False)))
    return marked.select(*columns, "_new")
