"""Keyed tables over Parquet: insert-or-replace, predictions and processed dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zephyrine.session import scratch_path

DATE_COLUMN = "event_date"
SEQ_COLUMN = "ingest_seq"
FEATURE_KEYS = ("city", "timestamp")


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = FEATURE_KEYS, order: Sequence[str] = (SEQ_COLUMN,)
) -> DataFrame:
    """One row per key, last write wins.

    A partial aggregate, so copies of one key collapse before the shuffle. Equal
    ``order`` values are settled by the remaining columns, which keeps reruns equal.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order]]
    latest = F.max(F.struct(*ranked)).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "_latest.*").select(*df.columns)


def merge_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """Union by name; batch sizes carry no meaning here."""
    merged: DataFrame | None = None
    for batch in batches:
        merged = batch if merged is None else merged.unionByName(batch, allowMissingColumns=True)
    if merged is None:
        raise ValueError("no batches to merge")
    return merged


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None while nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


_CONFLICT = "different rows of one batch share their keys and order"


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str] = FEATURE_KEYS,
    time_column: str = "timestamp",
    order: Sequence[str] = (SEQ_COLUMN,),
) -> DataFrame:
    """Insert-or-replace ``batch`` into the ``event_date``-partitioned table at ``path``.

    A higher ``order`` wins; at equal order the batch wins over what is stored. If the rows
    of one batch that would win under a key differ, no last write exists and the call fails,
    the table untouched. The batch is evaluated once; only its dates are read and rewritten.
    Merged dates are written in full beside the table and their folders then renamed into place;
    if a run dies in between, the next one finishes it first. One writer at a time; a reader
    during the swap may see some dates old, some new, or one missing for a moment.

    Beside the table lies one row per city with its first and last stored date.
    """
    pending = path.rstrip("/") + "__pending"
    if _exists(spark, f"{pending}/_SUCCESS"):
        _publish(spark, pending, path)
    arrived = scratch_path(spark, "batch")
    dated = batch.withColumn(DATE_COLUMN, F.to_date(time_column))
    dated.write.parquet(arrived)
    incoming = spark.read.schema(dated.schema).parquet(arrived)
    try:
        schema = _merge(spark, path, pending, incoming, keys, order)
    finally:
        remove(spark, arrived)
    if schema is None:
        stored = read_table(spark, path)
        return batch.limit(0) if stored is None else stored
    return spark.read.schema(schema).parquet(path)


def _merge(
    spark: SparkSession,
    path: str,
    pending: str,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
) -> StructType | None:
    """Merges and publishes; the schema of the table, None for an empty batch."""
    # One value per calendar day of the batch, whatever its number of rows.
    days = [row[0] for row in incoming.select(DATE_COLUMN).distinct().collect()]
    if None in days:
        raise ValueError("rows without a timestamp cannot be stored under (city, timestamp)")
    if not days:
        return None
    merged = incoming.withColumn("_arrived", F.lit(True))
    stored = read_table(spark, path)
    if stored is not None:
        touched = stored.filter(F.col(DATE_COLUMN).isin(days)).withColumn("_arrived", F.lit(False))
        merged = touched.unionByName(merged, allowMissingColumns=True)
    _note_cities(spark, path, incoming)
    latest = _latest_unless_torn(merged, [*keys, DATE_COLUMN], [*order, "_arrived"]).drop("_arrived")
    # Rebalancing splits a hot day over several writers and puts small days together.
    spread = latest.hint("rebalance", DATE_COLUMN).write.mode("overwrite").partitionBy(DATE_COLUMN)
    try:
        spread.parquet(pending)
    except PySparkException as error:
        if _CONFLICT in str(error):
            raise ValueError(f"{_CONFLICT}: {[*keys, *order]}") from error
        raise
    _publish(spark, pending, path)
    return latest.schema


def _latest_unless_torn(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` that fails if the winners of a key differ, in the same aggregate.

    The largest hash and the largest complement of a hash among the winners belong to one
    row, unless rows differ.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    if not rest:
        return latest_per_key(df, keys, order)
    content = F.xxhash64(*rest)
    found = df.groupBy(*keys).agg(
        F.max(F.struct(*order, *rest)).alias("_latest"),
        F.max(F.struct(*order, content.alias("h"))).getField("h").alias("_high"),
        F.max(F.struct(*order, F.bitwise_not(content).alias("h"))).getField("h").alias("_low"),
    )
    torn = F.col("_latest._arrived") & (F.col("_high") != F.bitwise_not("_low"))
    checked = F.when(torn, F.raise_error(F.lit(_CONFLICT)).cast("boolean")).otherwise(F.lit(True))
    return found.filter(checked).select(*keys, "_latest.*").select(*df.columns)


def _publish(spark: SparkSession, pending: str, path: str) -> None:
    """Move the pending date folders into the table; safe to repeat."""
    source, files = _hadoop(spark, pending)
    target, _ = _hadoop(spark, path)
    files.mkdirs(target)
    for status in files.listStatus(source):  # one folder per day of the batch
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{DATE_COLUMN}="):
            place, _ = _hadoop(spark, f"{path.rstrip('/')}/{name}")
            files.delete(place, True)
            if not files.rename(status.getPath(), place):
                raise OSError(f"{name} could not be moved into {path}")
    files.delete(source, True)
    spark.catalog.refreshByPath(path)


def stored_cities(spark: SparkSession, path: str) -> DataFrame | None:
    """``city, first_day, last_day`` of the table, or None before the first write."""
    sides = path.rstrip("/") + "__cities"
    whole = versions(spark, sides)
    if not whole:
        return None
    return spark.read.schema("city STRING, first_day DATE, last_day DATE").parquet(f"{sides}/{whole[-1]}")


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the finished writes in a folder of versions, the oldest first."""
    if not _exists(spark, folder):
        return []
    source, files = _hadoop(spark, folder)
    names = sorted(s.getPath().getName() for s in files.listStatus(source))
    return [n for n in names if _exists(spark, f"{folder}/{n}/_SUCCESS")]


def _note_cities(spark: SparkSession, path: str, incoming: DataFrame) -> None:
    """Widen the first and last date of the batch's cities, before the rows are stored.

    A run that dies afterwards leaves dates too wide, which costs reading but no result.
    """
    if "city" not in incoming.columns:
        return
    seen = incoming.groupBy("city").agg(
        F.min(DATE_COLUMN).alias("first_day"), F.max(DATE_COLUMN).alias("last_day")
    )
    before = stored_cities(spark, path)
    if before is not None:
        seen = before.unionByName(seen).groupBy("city").agg(
            F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
        )
    sides = path.rstrip("/") + "__cities"
    source, files = _hadoop(spark, sides)
    older = sorted(s.getPath().getName() for s in files.listStatus(source)) if _exists(spark, sides) else []
    version = int(older[-1].split("-")[1]) + 1 if older else 0
    named = seen.select(F.col("city").cast("string").alias("city"), "first_day", "last_day")
    named.write.mode("overwrite").parquet(f"{sides}/v-{version:012d}")
    for name in older[:-1]:  # the last but one may still be read
        remove(spark, f"{sides}/{name}")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder this process wrote for itself."""
    hadoop_path, files = _hadoop(spark, path)
    files.delete(hadoop_path, True)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, files = _hadoop(spark, path)
    return files.exists(hadoop_path)


def upsert_predictions(
    spark: SparkSession, path: str, predictions: DataFrame, predicted_at: dt.datetime, seq: int
) -> DataFrame:
    """Store forecast rows under (city, timestamp) with their wall-clock time."""
    batch = predictions.select(
        "city",
        "timestamp",
        F.lit(predicted_at).cast("timestamp").alias("predicted_at"),
        "aqi_pred_24h",
        "aqi_pred_48h",
        "aqi_pred_72h",
        F.lit(seq).cast("bigint").alias(SEQ_COLUMN),
    )
    return upsert(spark, path, batch)


# Forecast horizons in hours.
FORECAST_HORIZONS = [24, 48, 72]


def prediction_documents(predictions: DataFrame, generated_at: dt.datetime) -> DataFrame:
    """One JSON text per city: when made, on which data, values and horizons."""
    values = F.struct(*[F.col(f"aqi_pred_{h}h") for h in FORECAST_HORIZONS])
    document = F.struct(
        F.lit(generated_at).cast("timestamp").alias("generated_at"),
        F.col("timestamp").alias("based_on_data_at"),
        values.alias("predictions"),
        F.array(*[F.lit(h) for h in FORECAST_HORIZONS]).alias("horizons_hours"),
    )
    return predictions.select("city", F.to_json(document).alias("document"))


def write_predictions_json(predictions: DataFrame, path: str, generated_at: dt.datetime) -> None:
    """JSON lines, one per city: ``city`` and ``document``, in files of the writer's size."""
    prediction_documents(predictions, generated_at).write.mode("overwrite").json(path)


def save_processed_dates(dates: DataFrame, path: str) -> None:
    """Append days (column ``day``, and ``city`` where there is one) to the resume set.

    Duplicates are harmless.
    """
    city = ["city"] if "city" in dates.columns else []
    dates.select(*city, F.to_date("day").alias("day")).write.mode("append").parquet(path)


def load_processed_dates(spark: SparkSession, path: str, by_city: bool = False) -> DataFrame:
    stored = read_table(spark, path)
    if stored is None:
        return spark.createDataFrame([], "city STRING, day DATE" if by_city else "day DATE")
    return stored.distinct()
