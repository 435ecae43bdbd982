"""Live payloads and historical files to the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.functions.calendar import floor_hour, noon_stamp
from zephyrine.functions.index import pm25_to_aqi
from zephyrine.functions.numeric import exact_parts, half_even, joined_parts
from zephyrine.operators.joins import (
    climatology_join,
    combine_sources,
    day_status,
    with_neighbours,
)
from zephyrine.operators.profiling import backfill_summary, daily_pm25_mean
from zephyrine.operators.projection import assemble_feature_rows
from zephyrine.operators.quality import Rule, ingest_rules, split_valid, with_violations
from zephyrine.session import scratch_path
from zephyrine.sources.history import scan_history_csv, scan_named_history_csv
from zephyrine.schema import AQI_PAYLOAD_SCHEMA, WEATHER_PAYLOAD_SCHEMA
from zephyrine.sources.payloads import (
    aqi_parts,
    marked_payloads,
    read_payload_lines,
    weather_parts,
)
from zephyrine.sources.store import (
    DATE_COLUMN,
    SEQ_COLUMN,
    latest_per_key,
    load_processed_dates,
    merge_batches,
    read_table,
    remove,
    save_processed_dates,
    upsert,
    versions,
)
from zephyrine.sources.tables import read_feature_table, read_with_fallback


def as_rejected(df: DataFrame, source: str | Column) -> DataFrame:
    """What was turned down, whole as JSON, with its source and reason."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "reject_reason"]))
    named = F.lit(source) if isinstance(source, str) else source
    return df.select(named.alias("source"), F.col("reject_reason").alias("reason"), row.alias("row"))


# How long payloads that have met a partner are kept for newer partners, in days.
PARTNER_DAYS = 7
SIDES = ("aqi", "weather")


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hours(payloads: DataFrame) -> DataFrame:
    hour = floor_hour(F.col("fetched_at"))
    return payloads.select(F.col("city").alias("_city"), hour.alias("_hour")).distinct()


def _latest(payloads: DataFrame) -> DataFrame:
    """The latest payload per city and hour."""
    placed = payloads.withColumn("_at", floor_hour(F.col("fetched_at")))
    return latest_per_key(placed, ["city", "_at"], ["fetched_at", SEQ_COLUMN]).drop("_at")


def _of_hours(payloads: DataFrame, hours: DataFrame, how: str) -> DataFrame:
    hour = floor_hour(F.col("fetched_at"))
    return payloads.join(hours, (F.col("city") == F.col("_city")) & (hour == F.col("_hour")), how)


def _kept_folder(table: str, side: str) -> str:
    return f"{table.rstrip('/')}__{side}"


def _with_kept(spark: SparkSession, payloads: DataFrame, table: str, side: str, seq: int) -> DataFrame:
    """The payloads of a delivery and those kept from the deliveries before it."""
    folder = _kept_folder(table, side)
    older = [v for v in versions(spark, folder) if v < f"v-{seq:012d}"]
    if not older:
        return payloads
    return payloads.unionByName(spark.read.schema(payloads.schema).parquet(f"{folder}/{older[-1]}"))


def _keep(payloads: DataFrame, others: DataFrame, table: str, side: str, seq: int) -> None:
    """Keeps the latest payload per city and hour: alone ones, and those of the last days."""
    spark = payloads.sparkSession
    latest = _latest(payloads).withColumn("_at", floor_hour(F.col("fetched_at")))
    newest = payloads.agg(F.max("fetched_at")).first()[0]
    since = F.lit(newest) - F.expr(f"INTERVAL {PARTNER_DAYS} DAYS")
    recent = latest.filter(F.col("_at") >= since)
    old_and_alone = _of_hours(latest.filter(F.col("_at") < since), _hours(others), "left_anti")
    folder = _kept_folder(table, side)
    kept = recent.unionByName(old_and_alone).drop("_at")
    kept.write.mode("overwrite").parquet(f"{folder}/v-{seq:012d}")
    for name in versions(spark, folder)[:-2]:  # the last but one serves a run that is repeated
        remove(spark, f"{folder}/{name}")


def payloads_alone(spark: SparkSession, table: str) -> DataFrame | None:
    """``side, city, hour`` of payloads that wait for a partner, after the last delivery."""
    found = {}
    for side in SIDES:
        folder = _kept_folder(table, side)
        names = versions(spark, folder)
        if not names:
            return None
        found[side] = _hours(spark.read.parquet(f"{folder}/{names[-1]}"))
    parts = []
    for side, other in (SIDES, SIDES[::-1]):
        alone = found[side].join(found[other], ["_city", "_hour"], "left_anti")
        parts.append(alone.select(F.lit(side).alias("side"), F.col("_city").alias("city"), F.col("_hour").alias("hour")))
    return parts[0].unionByName(parts[1])


def _sifted(marked: DataFrame, source: str, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid payloads of one side, and ``source, reason, row`` of all others from one scan."""
    parsed = [c for c in marked.columns if c not in ("raw", "reject_reason")]
    valid, _ = split_valid(marked.filter("reject_reason IS NULL").select(*parsed), rules)
    outside = F.when(F.size("violations") > 0, F.lit("outside the ingest rules"))
    told = with_violations(marked, rules).select(
        F.lit(source).alias("source"),
        F.coalesce(F.col("reject_reason"), outside).alias("reason"),
        F.when(F.col("reject_reason").isNotNull(), F.to_json("raw")).otherwise(F.to_json(F.struct(*parsed))).alias("row"),
    )
    return valid, told.filter("reason IS NOT NULL")


def sifted_payloads(raw_air: DataFrame, raw_weather: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Valid air and valid weather payloads, and ``source, reason, row`` of all others.

    The guard in front of the store is applied to each side, so that the latest valid payload
    counts. Works on streams, too.
    """
    of_weather = {"temperature"}
    air, bad_air = _sifted(
        marked_payloads(raw_air, *aqi_parts(raw_air)), "aqi", [r for r in ingest_rules() if r.name not in of_weather]
    )
    weather, bad_weather = _sifted(
        marked_payloads(raw_weather, *weather_parts(raw_weather)),
        "weather",
        [r for r in ingest_rules() if r.name in of_weather],
    )
    return air, weather, merge_batches([bad_air, bad_weather])


def ingest_payloads(
    spark: SparkSession,
    aqi_path: str,
    weather_path: str,
    table: str,
    seq: int,
    rejects: str | None = None,
) -> DataFrame:
    """Payload files of any number of cities and hours to upserted feature rows.

    A payload without a partner of its city and hour waits beside the table and is matched
    with later deliveries (``payloads_alone`` shows them); those that met one stay for newer
    partners for ``PARTNER_DAYS``. ``seq`` must rise from delivery to delivery, a repeated run
    keeps its number. Of an hour the latest valid payload of either side counts. Unreadable payloads and those the guard turns down are appended to
    ``rejects`` (``source, reason, row``); without such a path a single one of them fails the
    call, since nothing may vanish unseen.
    """
    good_air, good_weather, all_refused = sifted_payloads(
        read_payload_lines(spark, aqi_path, AQI_PAYLOAD_SCHEMA),
        read_payload_lines(spark, weather_path, WEATHER_PAYLOAD_SCHEMA),
    )
    if rejects is not None:
        all_refused.write.mode("append").parquet(rejects)
    elif not all_refused.isEmpty():
        raise ValueError(f"payloads were turned down: {all_refused.first()}")
    # Only the latest of an hour counts from here on. Written once: the match, the days, the
    # look-back and the merge all read these rows.
    good_air, good_weather = _written(_latest(good_air), "air"), _written(_latest(good_weather), "weather")
    every_air = _written(_with_kept(spark, good_air, table, "aqi", seq), "all-air")
    every_weather = _written(_with_kept(spark, good_weather, table, "weather", seq), "all-weather")
    touched = _written(_hours(good_air).union(_hours(good_weather)).distinct(), "hours")
    readings = combine_sources(
        _of_hours(every_air, touched, "left_semi"), _of_hours(every_weather, touched, "left_semi")
    ).drop("fetched_at", "weather_desc")
    stamped = readings.drop(SEQ_COLUMN).withColumn(SEQ_COLUMN, F.lit(seq).cast("bigint"))
    stored = store_features(spark, table, _written(stamped, "readings"))
    _keep(every_air, every_weather, table, "aqi", seq)
    _keep(every_weather, every_air, table, "weather", seq)
    return stored


def store_features(
    spark: SparkSession, table: str, rows: DataFrame, calendar: Column | None = None
) -> DataFrame:
    """Feature rows of readings, with change rates from true history, into the table.

    ``rows`` has one row per city and time stamp, and ``ingest_seq``; ``calendar`` gives the
    time calendar features come from where it is not the stamp.
    """
    placed = with_neighbours(rows, table)
    placed = placed.withColumn("_calendar", F.col("timestamp") if calendar is None else calendar)
    features = assemble_feature_rows(placed, "_calendar", extra=[SEQ_COLUMN, "_new"])
    return upsert(spark, table, features.filter("_new").drop("_new"))


def daily_readings(daily: DataFrame) -> DataFrame:
    """Daily (city, timestamp, pm25, aqi) rows with keyed stand-in weather, stamped at noon."""
    key = F.concat_ws("|", F.col("city"), F.unix_seconds("midnight"))
    weather = climatology_join(
        daily.withColumn("midnight", F.date_trunc("day", F.col("timestamp"))), "midnight", key
    )
    return weather.withColumn("timestamp", noon_stamp(F.col("midnight")))


def daily_feature_rows(daily: DataFrame) -> DataFrame:
    """``daily_readings`` to feature-table columns.

    Calendar features come from midnight; the stored stamp is noon.
    """
    return assemble_feature_rows(daily_readings(daily), calendar_column="midnight")


def history_feature_rows(spark: SparkSession, csv_path: str, city: str) -> DataFrame:
    """A historical two-column CSV to feature-table rows."""
    history = scan_history_csv(spark, csv_path).withColumn("city", F.lit(city))
    return daily_feature_rows(history.withColumn("aqi", pm25_to_aqi(F.col("pm25"))))


def csv_backfill(spark: SparkSession, csv_path: str, city: str, table: str, seq: int) -> DataFrame:
    """A historical CSV into the feature table; returns ``total`` and ``pushed`` rows.

    A day that occurs more than once keeps its largest value.
    """
    history = scan_history_csv(spark, csv_path).withColumn("city", F.lit(city))
    once = history.groupBy("city", "timestamp").agg(F.max("pm25").alias("pm25"), F.count("*").alias("_n"))
    path = scratch_path(spark, "history")
    once.write.parquet(path)
    once = spark.read.parquet(path)
    rows = daily_readings(once.drop("_n").withColumn("aqi", pm25_to_aqi(F.col("pm25"))))
    rows = rows.drop("midnight").withColumn(SEQ_COLUMN, F.lit(seq).cast("bigint"))
    store_features(spark, table, rows, F.date_trunc("day", F.col("timestamp")))
    return once.agg(F.sum("_n").alias("total"), F.count("*").alias("pushed"))


def fallback_features(spark: SparkSession, csv_path: str, city: str) -> DataFrame:
    """Stand-in for the feature table: local history with plain monthly climate means."""
    history = scan_named_history_csv(spark, csv_path, city)
    return climatology_join(history.withColumn("aqi", pm25_to_aqi(F.col("pm25"))))


def load_features(spark: SparkSession, table: str, csv_path: str, city: str) -> DataFrame:
    return read_with_fallback(
        lambda: read_feature_table(spark, table),
        lambda: fallback_features(spark, csv_path, city),
    )[0]


def backfill(
    spark: SparkSession,
    measurements: DataFrame,
    spine: DataFrame,
    table: str,
    processed_path: str,
    seq: int,
    city: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Daily means of the pending days to the feature table; returns the summary.

    ``measurements`` has ``city, day, value``; with ``city`` all belong to that one. Days are
    done per city, so cities may join later; the spine's days are expected of every city
    that has measurements. A day without valid ones counts as failed and as processed. The
    change rate of a resumed run goes on from the stored day before. A dry run writes
    nothing, the resume set included.
    """
    if city is not None:
        measurements = measurements.withColumn("city", F.lit(city))
    days = sorted(r["day"] for r in spine.select("day").distinct().collect())  # calendar days
    every_day = F.explode(F.array(*[F.lit(d) for d in days]).cast("array<date>")).alias("day")
    expected = measurements.select("city").distinct().select("city", every_day)
    processed = load_processed_dates(spark, processed_path, by_city=True)
    path = scratch_path(spark, "status")
    day_status(expected, processed, measurements, keys=("city", "day")).write.parquet(path)
    status = spark.read.parquet(path)
    summary = backfill_summary(status)
    pending = status.filter("status <> 'skipped'").select("city", "day")
    if not dry_run and not pending.isEmpty():
        wanted = measurements.join(pending, ["city", "day"], "left_semi")
        store_daily(spark, daily_pm25_mean(wanted), table, seq)
        save_processed_dates(pending, processed_path)
    return summary


def store_daily(spark: SparkSession, daily: DataFrame, table: str, seq: int) -> None:
    """Daily ``city, day, pm25, aqi`` as feature rows into the table."""
    rows = daily_readings(daily.withColumn("timestamp", F.col("day").cast("timestamp")))
    rows = rows.drop("midnight", "day").withColumn(SEQ_COLUMN, F.lit(seq).cast("bigint"))
    store_features(spark, table, rows, F.date_trunc("day", F.col("timestamp")))


def backfill_delivery(
    spark: SparkSession, measurements: DataFrame, table: str, processed_path: str, seq: int
) -> None:
    """One delivery of measurements (``city, day, value``), merged with those before it.

    Beside the resume set lies one row per city, day and delivery with the exact sum and the
    count of its valid measurements; the mean of a day comes from all of them, so a day may be cut over any
    deliveries, and a delivery that runs again replaces its own rows. Only the days a city has
    rows for are done. Days that another job has put into the resume set are skipped.
    """
    sums_path = processed_path.rstrip("/") + "__sums"
    valid = F.col("value").isNotNull() & (F.col("value") >= 0)
    coarse, fine = exact_parts(F.col("value"))
    delivery, pending = scratch_path(spark, "delivery"), scratch_path(spark, "wanted")
    measurements.filter("city IS NOT NULL AND day IS NOT NULL").groupBy("city", "day").agg(
        F.coalesce(F.sum(F.when(valid, coarse)), F.lit(0)).alias("coarse"),
        F.coalesce(F.sum(F.when(valid, fine)), F.lit(0)).alias("fine"),
        F.count(F.when(valid, 1)).alias("n"),
    ).write.parquet(delivery)
    arrived = spark.read.parquet(delivery)
    dates = F.broadcast(arrived.select(F.col("day").alias(DATE_COLUMN)).distinct())  # calendar days
    done = load_processed_dates(spark, processed_path, by_city=True).select("city", "day")
    stored = read_table(spark, sums_path)
    if stored is not None:
        known = stored.join(dates, DATE_COLUMN, "left_semi")
        done = done.join(known.select("city", F.col(DATE_COLUMN).alias("day")), ["city", "day"], "left_anti")
    arrived.join(done, ["city", "day"], "left_anti").write.parquet(pending)
    wanted = spark.read.schema(arrived.schema).parquet(pending)
    if not wanted.isEmpty():
        _merge_delivery(spark, wanted, dates, sums_path, table, seq)
        save_processed_dates(wanted.select("city", "day"), processed_path)
    remove(spark, delivery)
    remove(spark, pending)


def _merge_delivery(
    spark: SparkSession, wanted: DataFrame, dates: DataFrame, sums_path: str, table: str, seq: int
) -> None:
    """Stores the delivery's sums and the means of its days over all deliveries."""
    own = wanted.withColumns(
        {"timestamp": F.col("day").cast("timestamp"), "delivery": F.lit(seq).cast("bigint")}
    ).withColumn(SEQ_COLUMN, F.lit(seq).cast("bigint"))
    sums = upsert(spark, sums_path, own.drop("day"), keys=("city", "timestamp", "delivery"))
    merged = (
        sums.join(dates, DATE_COLUMN, "left_semi")
        .withColumnRenamed(DATE_COLUMN, "day")
        .join(wanted.select("city", "day"), ["city", "day"], "left_semi")
        .groupBy("city", "day")
        .agg(joined_parts(F.sum("coarse"), F.sum("fine")).alias("total"), F.sum("n").alias("n"))
        .filter("n > 0")
        .select("city", "day", half_even(F.col("total") / F.col("n"), 2).alias("pm25"))
    )
    store_daily(spark, merged.withColumn("aqi", pm25_to_aqi(F.col("pm25"))), table, seq)
