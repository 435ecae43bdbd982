"""Registration, table reads, label folds and written intermediates of these operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zephyrine.session import scratch_path, use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Rows of ids or short keys that may be broadcast: 16 bytes each, 16 MB at most.
BROADCAST_ROWS = 1_000_000

# Texts per Arrow batch, and its bytes: a worker holds one batch at a time.
BATCH_ROWS, BATCH_BYTES = 256, "4m"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(use_utc(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % parts


def small_batches(spark: SparkSession) -> None:
    """Long texts make large batches, so a batch of them holds few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes written tables that nothing reads any more."""
    for df in tables:
        for name in df.inputFiles()[:1]:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a written side for broadcast if its counted rows are within ``bound``.

    Beyond it the join stays as Spark plans it, with both sides shuffled.
    """
    count = df.count() if rows is None else rows
    return F.broadcast(df) if count <= bound else df


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def extended(df: DataFrame, more: str) -> StructType:
    """The frame's schema and the fields of ``more``."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def hashed_sample(df: DataFrame, key: str, rows: int, wanted: int) -> DataFrame:
    """About ``wanted`` of ``rows`` rows, chosen by a hash of their key; all if there are fewer.

    The choice is a filter, so no task gathers the sample; it varies by its square root.
    """
    if rows <= wanted:
        return df
    steps = 1 << 40
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(steps))
    return df.filter(place < int(steps * wanted / rows))
