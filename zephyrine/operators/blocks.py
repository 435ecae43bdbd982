"""Row-frame windows over series of any length.

``Window.partitionBy(series)`` sends a whole series to one task. That is fine for
the keyed feature table, where the calendar bounds a series (one row per hour). It
is not fine for raw readings, where one city may hold a third of all rows. Here a
series is cut into blocks of equal row count, each block borrows the few rows its
frames reach into, and every window runs inside one block. Results are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from zephyrine.session import scratch_path

BLOCK_ROWS = 200_000

# ``monotonically_increasing_id`` keeps the partition number above this many low bits.
_ROW_BITS = 33


def written_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows in series order over range partitions, written to the shared folder.

    ``_row`` numbers the rows of a slice in order. Ties in a key split over slices, so a
    hot series is spread evenly. The slices are written because their numbers must be
    the same each time they are read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "slices")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_row", _ROW_BITS))
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def _with_slice_starts(
    rows: DataFrame, keys: Sequence[str], size: Column
) -> DataFrame:
    """Adds, per (series, slice), its first ``_row`` and the ``size`` of earlier slices.

    The joined side has at most one row per series and slice it touches: as many rows as
    there are series and slices together.
    """
    sizes = rows.groupBy(*keys, "_slice").agg(
        size.cast("bigint").alias("_size"), F.min("_row").alias("_first")
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_slice").alias("_slice_of"),
        "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
    )
    same = F.col("_slice") == F.col("_slice_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return rows.join(starts, same)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position"
) -> DataFrame:
    """Adds the 0-based place of each row in its series, without a window over the rows.

    ``order`` must be unique within a series.
    """
    placed = _with_slice_starts(written_slices(df, keys, order), keys, F.count("*"))
    position = F.col("_start") + F.col("_row") - F.col("_first")
    return placed.select(*df.columns, position.alias(name))


def running_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, name: str
) -> DataFrame:
    """Adds the total ``weight`` of the earlier rows of the series."""
    rows = written_slices(df, keys, order)
    window = Window.partitionBy(*keys, "_slice").orderBy("_row")
    earlier = F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, -1))
    local = F.coalesce(earlier, F.lit(0)).cast("bigint")
    placed = _with_slice_starts(rows.withColumn("_local", local), keys, F.sum(weight))
    return placed.select(*df.columns, (F.col("_start") + F.col("_local")).alias(name))


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    back: int,
    ahead: int = 0,
    block_rows: int | None = None,
) -> DataFrame:
    """Adds ``columns(window)`` to every row.

    ``back`` and ``ahead`` are the furthest rows any frame reaches. With ``block_rows``
    unset a series is one window partition, for keyed tables whose series the calendar
    bounds; over raw readings give ``BLOCK_ROWS``. All columns of ``df`` travel through the
    shuffles, so select the needed ones before.
    """
    if block_rows is None:
        return df.withColumns(columns(Window.partitionBy(*keys).orderBy(*order)))
    if block_rows < max(back, ahead, 1):
        raise ValueError(f"block_rows must be at least {max(back, ahead, 1)}")
    placed = number_rows(df, keys, order, "_position")
    home = F.floor(F.col("_position") / F.lit(block_rows)).cast("bigint")
    within = F.pmod(F.col("_position"), F.lit(block_rows))
    homes = F.array(
        home,
        F.when(within >= block_rows - back, home + 1),
        F.when((within < ahead) & (home > 0), home - 1),
    )
    spread = placed.withColumn("_block", F.explode(F.array_compact(homes)))
    window = Window.partitionBy(*keys, "_block").orderBy("_position")
    return (
        spread.withColumns(columns(window))
        .filter(F.col("_block") == home)
        .drop("_block", "_position")
    )
