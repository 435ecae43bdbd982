"""Row rules, guards and profiling reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.operators.profiling import (
    daily_pm25_mean,
    describe_column,
    distinct_count,
    duplicate_rows,
    missing_counts,
    monthly_stats,
    regression_metrics,
    table_profile,
    time_range,
    value_counts_by_value,
)
from zephyrine.operators.learning import fit_medians, fit_scaler, impute_median, standardize
from zephyrine.operators.quality import (
    count_violations,
    filter_valid_measurements,
    frame_rules,
    ingest_rules,
    min_rows_guard,
    recent_above,
    split_valid,
    validate_feature_frame,
    with_violations,
)
from zephyrine.operators.projection import drop_missing
from zephyrine.operators.ranking import (
    first_n,
    last_n,
    sort_by_time,
    time_series_listing,
    time_split,
    top_values,
)
from zephyrine.registry.base import (
    READING_ORDER,
    daily,
    day_text,
    hourly,
    on_daily,
    on_hourly,
    on_readings,
    query,
    r6,
    readings,
    rounded,
    sql_aqi,
    sql_day,
    sql_exact_mean,
    sql_r,
    sql_text,
    text,
)
from zephyrine.sources.tables import filter_city

ID = "reading_id"


@query(
    "pf6_filter_valid_measurements",
    on_readings("SELECT reading_id, pm10 - 60 AS value FROM readings WHERE pm10 IS NOT NULL AND pm10 - 60 >= 0"),
)
def _valid_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select(ID, (F.col("pm10") - 60).alias("value"))
    return filter_valid_measurements(rows)


@query("pf7_filter_city", on_readings("SELECT reading_id, city, aqi FROM readings WHERE city = 'click'"))
def _filter_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_city(readings(spark, sf_dir), "click").select(ID, "city", "aqi")


@query(
    "pf8_drop_missing",
    on_readings("SELECT reading_id, pm10 FROM readings WHERE pm10 IS NOT NULL AND humidity IS NOT NULL"),
)
def _drop_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing(readings(spark, sf_dir), ["pm10", "humidity"]).select(ID, "pm10")


def shaken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with some values pushed out of range or removed."""
    number = F.col(ID)
    return readings(spark, sf_dir).select(
        ID,
        "city",
        F.when(number % 23 != 0, F.col("ts")).alias("timestamp"),
        F.when(number % 29 != 0, F.col("aqi") * 3 - 5).alias("aqi"),
        F.when(number % 9 != 0, F.col("humidity") + 5).alias("humidity"),
        (F.col("temperature") * 4 - 80).alias("temperature"),
        F.when(number % 10 != 0, F.col("pressure") - 985).alias("pressure"),
        F.when(number % 10 != 1, F.col("wind_speed") - 1).alias("wind_speed"),
    )


SHAKEN_SQL = """shaken AS (SELECT reading_id, city,
  CASE WHEN reading_id % 23 <> 0 THEN ts END AS ts,
  CASE WHEN reading_id % 29 <> 0 THEN aqi * 3 - 5 END AS aqi,
  CASE WHEN reading_id % 9 <> 0 THEN humidity + 5 END AS humidity,
  temperature * 4 - 80 AS temperature,
  CASE WHEN reading_id % 10 <> 0 THEN pressure - 985 END AS pressure,
  CASE WHEN reading_id % 10 <> 1 THEN wind_speed - 1 END AS wind_speed FROM readings)"""

RULE_SQL = {
    "timestamp": "ts IS NULL",
    "aqi_missing": "aqi IS NULL",
    "aqi_range": "NOT coalesce(aqi BETWEEN 0 AND 500, false)",
    "humidity": "NOT coalesce(humidity BETWEEN 0 AND 100, false)",
    "temperature": "NOT coalesce(temperature BETWEEN -90 AND 70, false)",
    "pressure": "coalesce(pressure <= 0, false)",
    "wind_speed": "coalesce(wind_speed < 0, false)",
}


@query(
    "pf10_rule_counts",
    on_readings(
        " UNION ALL ".join(
            f"SELECT {i} AS rule_no, '{name}' AS rule, count(*) FILTER (WHERE {rule}) AS broken_rows FROM shaken"
            for i, (name, rule) in enumerate(RULE_SQL.items(), 1)
        ),
        SHAKEN_SQL,
    ),
)
def _rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_violations(shaken(spark, sf_dir), frame_rules())


@query(
    "pf10_quarantine",
    on_readings(
        "SELECT reading_id, concat_ws(',', "
        + ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in RULE_SQL.items())
        + ") AS violations FROM shaken WHERE "
        + " OR ".join(f"({rule})" for rule in RULE_SQL.values()),
        SHAKEN_SQL,
    ),
)
def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_valid(shaken(spark, sf_dir), frame_rules())
    return bad.select(ID, F.array_join("violations", ",").alias("violations"))


@query(
    "pf9_pf10_validated_frame",
    on_readings(
        f"SELECT reading_id, {sql_text('ts')} AS ts, aqi FROM readings WHERE aqi BETWEEN 0 AND 500 "
        "AND humidity BETWEEN 0 AND 100"
    ),
)
def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    good, _ = split_valid(rows, frame_rules())
    return validate_feature_frame(good).select(ID, text("timestamp").alias("ts"), "aqi")


@query(
    "pf11_ingest_guard",
    on_readings(
        "SELECT reading_id, concat_ws(',', CASE WHEN aqi IS NULL THEN 'aqi_missing' END, "
        "CASE WHEN NOT coalesce(aqi >= 0, false) THEN 'aqi_negative' END, "
        "CASE WHEN NOT coalesce(aqi <= 500, false) THEN 'aqi_high' END, "
        "CASE WHEN NOT coalesce(temperature > -90, false) THEN 'temperature' END) AS violations FROM shaken",
        SHAKEN_SQL,
    ),
)
def _ingest_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = with_violations(shaken(spark, sf_dir), ingest_rules())
    return marked.select(ID, F.array_join("violations", ",").alias("violations"))


@query(
    "pf12_min_rows_guard",
    on_daily(f"SELECT {sql_day('ts')} AS day, count(*) AS n FROM daily GROUP BY ALL"),
)
def _min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = min_rows_guard(daily(spark, sf_dir, []), 50)
    return rows.groupBy(day_text("timestamp").alias("day")).agg(F.count("*").alias("n"))


@query(
    "pf13_recent_above",
    on_readings(
        f"SELECT city, reading_id, {sql_text('ts')} AS ts, aqi FROM (SELECT *, count(*) OVER (PARTITION BY city) AS n "
        "FROM (SELECT * FROM readings WHERE aqi > 75 QUALIFY row_number() OVER "
        "(PARTITION BY city ORDER BY ts DESC, reading_id DESC) <= 90)) WHERE n > 5"
    ),
)
def _recent_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recent_above(readings(spark, sf_dir), order=READING_ORDER)
    return rows.select("city", ID, text("ts").alias("ts"), "aqi")


SPLIT_SQL = (
    "SELECT part, count(*) AS n, {low} AS first_ts, {high} AS last_ts, {aqi} AS mean_aqi FROM ("
    "SELECT *, CASE WHEN ts <= (SELECT max(ts) FROM readings) - INTERVAL 7 DAY THEN 'train' "
    "ELSE 'test' END AS part FROM readings) GROUP BY part"
).format(low=sql_text("min(ts)"), high=sql_text("max(ts)"), aqi=sql_r("avg(aqi)"))


def _split_report(train: DataFrame, test: DataFrame) -> DataFrame:
    def report(df: DataFrame, part: str) -> DataFrame:
        return df.groupBy(F.lit(part).alias("part")).agg(
            F.count("*").alias("n"),
            text(F.min("ts")).alias("first_ts"),
            text(F.max("ts")).alias("last_ts"),
            r6(F.avg("aqi")).alias("mean_aqi"),
        )

    return report(train, "train").unionByName(report(test, "test"))


@query("pf15_time_split", on_readings(SPLIT_SQL))
def _time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_report(*time_split(readings(spark, sf_dir), 7, "ts"))


@query(
    "pf15_time_split_per_city",
    on_readings(
        "SELECT city, part, count(*) AS n FROM (SELECT city, CASE WHEN ts <= max(ts) OVER (PARTITION BY city) "
        "- INTERVAL 7 DAY THEN 'train' ELSE 'test' END AS part FROM readings) GROUP BY ALL"
    ),
)
def _time_split_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = time_split(readings(spark, sf_dir), 7, "ts", per_city=True)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("city", "part").agg(F.count("*").alias("n"))


@query(
    "a1_daily_pm25_mean",
    on_readings(
        f"SELECT city, {sql_day('day')} AS day, pm25, {sql_aqi('pm25')} AS aqi FROM ("
        f"SELECT city, CAST(ts AS DATE) AS day, {sql_r(sql_exact_mean('pm25'), 2)} AS pm25 FROM readings "
        "WHERE pm25 >= 0 GROUP BY ALL)"
    ),
)
def _daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return daily_pm25_mean(rows, value="pm25").withColumn("day", day_text("day"))


DESCRIBE = ["mean", "std", "min", "p25", "p50", "p75", "max"]


def describe_sql(column: str) -> str:
    return on_readings(
        f"SELECT count({column}) AS count, {sql_r(f'avg({column})')} AS mean, "
        f"{sql_r(f'stddev_samp({column})')} AS std, {sql_r(f'min({column})')} AS min, "
        f"{sql_r(f'quantile_cont({column}, 0.25)')} AS p25, {sql_r(f'quantile_cont({column}, 0.5)')} AS p50, "
        f"{sql_r(f'quantile_cont({column}, 0.75)')} AS p75, {sql_r(f'max({column})')} AS max FROM readings"
    )


@query("a2_describe_column", describe_sql("aqi"))
def _describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe_column(readings(spark, sf_dir), "aqi"), ["count"], DESCRIBE)


@query("a2_describe_column_ranked", describe_sql("pm25"))
def _describe_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report of a second column."""
    return rounded(describe_column(readings(spark, sf_dir), "pm25"), ["count"], DESCRIBE)


@query("a3_distinct_count", on_readings("SELECT count(DISTINCT aqi) AS distinct_values FROM readings"))
def _distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_count(readings(spark, sf_dir), "aqi")


@query(
    "a4_monthly_stats",
    "SELECT strftime(o_orderdate, '%Y-%m') AS year_month, round_even(avg(o_totalprice), 4) + 0.0 AS mean, "
    "min(o_totalprice) AS min, max(o_totalprice) AS max, round_even(stddev_samp(o_totalprice), 4) + 0.0 AS std "
    "FROM orders GROUP BY 1",
)
def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zephyrine.functions.numeric import half_even

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    stats = monthly_stats(orders, "o_orderdate", "o_totalprice")
    return stats.withColumns({c: half_even(F.col(c), 4) for c in ("mean", "std")})


@query(
    "a4_monthly_aqi",
    on_readings(
        f"SELECT strftime(ts, '%Y-%m') AS year_month, {sql_r('avg(aqi)')} AS mean, min(aqi) AS min, "
        f"max(aqi) AS max, {sql_r('stddev_samp(aqi)')} AS std FROM readings GROUP BY 1"
    ),
)
def _monthly_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = monthly_stats(readings(spark, sf_dir), "ts")
    return stats.withColumns({c: r6(c) for c in ("mean", "std")})


@query(
    "a5_table_profile",
    on_readings(
        "SELECT count(*) AS rows, 12 AS columns, "
        "'reading_id,city,station_id,ts,pm25,aqi,humidity,temperature,pressure,wind_speed,pm10,no2' AS column_names, "
        "min(aqi) AS min, max(aqi) AS max, count(DISTINCT aqi) AS distinct_values FROM readings"
    ),
)
def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_profile(readings(spark, sf_dir))


@query(
    "a6_value_counts_by_value",
    on_readings("SELECT aqi, count(*) AS n FROM readings WHERE aqi IS NOT NULL GROUP BY aqi ORDER BY aqi"),
)
def _value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts_by_value(readings(spark, sf_dir))


@query(
    "a7_missing_counts",
    on_readings(
        "SELECT * FROM (SELECT 'pm10' AS column_name, count(*) FILTER (WHERE pm10 IS NULL) AS missing FROM readings "
        "UNION ALL SELECT 'no2', count(*) FILTER (WHERE no2 IS NULL) FROM readings "
        "UNION ALL SELECT 'humidity', count(*) FILTER (WHERE humidity IS NULL) FROM readings "
        "UNION ALL SELECT 'aqi', count(*) FILTER (WHERE aqi IS NULL) FROM readings) WHERE missing > 0"
    ),
)
def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_counts(readings(spark, sf_dir))


@query(
    "a8_duplicate_rows",
    on_readings(
        "SELECT count(*) - count(DISTINCT struct_pack(a := station_id, b := pm10, c := CAST(ts AS DATE))) "
        "AS duplicates FROM readings"
    ),
)
def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("station_id", "pm10", F.to_date("ts").alias("day"))
    return duplicate_rows(rows)


@query(
    "a9_time_range",
    on_readings(f'SELECT {sql_text("min(ts)")} AS start, {sql_text("max(ts)")} AS "end" FROM readings'),
)
def _time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_range(readings(spark, sf_dir), "ts").select(text("start").alias("start"), text("end").alias("end"))


@query(
    "a10_m1_impute_median",
    on_readings(
        "SELECT reading_id, coalesce(pm10, m10) AS pm10, coalesce(humidity, mh) AS humidity FROM readings, "
        "(SELECT median(pm10) AS m10, median(humidity) AS mh FROM readings "
        "WHERE ts <= (SELECT max(ts) FROM readings) - INTERVAL 7 DAY)"
    ),
)
def _impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of the training rows, applied to all rows; an empty column has none."""
    rows = readings(spark, sf_dir)
    train, _ = time_split(rows, 7, "ts")
    medians = fit_medians(train, ["pm10", "humidity", "no2"])
    return impute_median(rows, medians).select(ID, *medians)


SCALED = ["aqi", "temperature", "humidity", "pressure"]


@query(
    "a11_m2_standardize",
    on_readings(
        "SELECT reading_id, "
        + ", ".join(
            f"{sql_r(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in SCALED
        )
        + " FROM readings"
    ),
)
def _standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    return rounded(standardize(rows, *fit_scaler(rows, SCALED)), [ID], SCALED)


@query(
    "a12_regression_metrics",
    on_daily(
        f"SELECT count(*) AS rows, {sql_r('sqrt(avg(e * e))')} AS rmse, {sql_r('avg(abs(e))')} AS mae, "
        f"{sql_r('1 - sum(e * e) / (var_pop(aqi) * count(*))')} AS r2 FROM ("
        "SELECT aqi, aqi - lag(aqi) OVER (PARTITION BY station_id ORDER BY ts) AS e FROM daily "
        "QUALIFY e IS NOT NULL)"
    ),
)
def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The naive forecast that repeats the station's last daily value."""
    from pyspark.sql import Window

    series = Window.partitionBy("station_id").orderBy("timestamp")
    rows = daily(spark, sf_dir, ["aqi"]).select("aqi", F.lag("aqi", 1).over(series).alias("prediction"))
    report = regression_metrics(rows.dropna(), label="aqi")
    return rounded(report, ["rows"], ["rmse", "mae", "r2"])


@query(
    "t1_sort_by_time",
    on_hourly(f"SELECT city, {sql_text('\"timestamp\"')} AS ts, aqi FROM hourly ORDER BY ts, city"),
)
def _sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sort_by_time(hourly(spark, sf_dir, ["aqi"]), ["timestamp", "city"])
    return rows.select("city", text("timestamp").alias("ts"), "aqi")


FIRST_SQL = f"SELECT reading_id, {sql_text('ts')} AS ts, aqi FROM readings ORDER BY readings.ts, reading_id LIMIT 10"
LAST_SQL = (
    f"SELECT reading_id, {sql_text('ts')} AS ts, aqi FROM readings ORDER BY readings.ts DESC, reading_id DESC LIMIT 10"
)


@query("t2_first_n", on_readings(FIRST_SQL))
def _first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_n(readings(spark, sf_dir), 10, READING_ORDER).select(ID, text("ts").alias("ts"), "aqi")


@query("t2_last_n", on_readings(LAST_SQL))
def _last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_n(readings(spark, sf_dir), 10, READING_ORDER).select(ID, text("ts").alias("ts"), "aqi")


@query(
    "t3_top_values",
    on_readings("SELECT aqi, count(*) AS n FROM readings GROUP BY aqi ORDER BY n DESC, aqi LIMIT 20"),
)
def _top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(readings(spark, sf_dir))


@query(
    "t6_time_series_listing",
    on_readings(
        f"SELECT {sql_text('ts')} AS ts, aqi FROM readings "
        "WHERE ts > (SELECT max(ts) FROM readings) - INTERVAL 7 DAY"
    ),
)
def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = time_split(readings(spark, sf_dir), 7, "ts")
    return time_series_listing(test, "ts").select(text("ts").alias("ts"), "aqi")
