"""The registered queries' inputs, derived from the given tables.

Each relation exists twice: as a DataFrame and as the SQL that defines the same rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline import functions as fx
from loamline.config import Calibration, PipelineConfig, ValueRange
from loamline.staging import new_path, share

# Constants of the registered queries.
READINGS_AS_OF = datetime(2024, 1, 31)
RUNS_AS_OF = datetime(2001, 8, 1)
ZONE_MINUTES = 330  # the default target zone, which has no daylight saving

# Dimensions that exercise a non-identity calibration and the defaults.
CONFIG = PipelineConfig(
    calibrations={"click": Calibration(1.02, -1.0)},
    ranges={"click": ValueRange(0.0, 60.0), "error": ValueRange(5.0, 120.0)},
)
PLAIN = PipelineConfig(ranges=CONFIG.ranges)  # identity calibration


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """``events`` as readings: user → sensor, event type → reading type, props.k → battery."""
    keep = ["event_id"] if with_id else []
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("sensor_id"),
        fx.instant_of(F.col("ts"), T.TimestampNTZType()).alias("timestamp"),
        F.col("event_type").alias("reading_type"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("battery_level"),
        *keep,
    )


READINGS_SQL = """
readings AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, ts AS "timestamp",
         ts + INTERVAL 330 MINUTE AS wall, event_type AS reading_type, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS battery_level
  FROM events)"""


def readings_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with copies, missing batteries, values and sensors by rule."""
    base = readings(spark, sf_dir, with_id=True)
    every = lambda n: F.col("event_id") % n == 0
    holed = base.withColumns(
        {
            "battery_level": F.when(~every(7), F.col("battery_level")),
            "value": F.when(~every(11), F.col("value")),
            "sensor_id": F.when(~every(97), F.col("sensor_id")),
        }
    )
    copies = F.when(every(50), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return holed.withColumn("copy", F.explode(copies)).drop("copy", "event_id")


DIRTY_SQL = (
    READINGS_SQL
    + """,
readings_dirty AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN sensor_id END AS sensor_id, "timestamp", wall,
         reading_type, CASE WHEN event_id % 11 <> 0 THEN value END AS value,
         CASE WHEN event_id % 7 <> 0 THEN battery_level END AS battery_level
  FROM (SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE event_id % 50 = 0)),
deduped AS (SELECT DISTINCT * FROM readings_dirty),
cleaned AS (
  SELECT sensor_id, "timestamp", wall, reading_type, value,
         coalesce(battery_level, 100.0) AS battery_level
  FROM deduped
  WHERE sensor_id IS NOT NULL AND "timestamp" IS NOT NULL AND reading_type IS NOT NULL
    AND value IS NOT NULL)"""
)

# The enrichment as SQL, on ``cleaned``, with CONFIG's dimensions.
ENRICHED_SQL = (
    DIRTY_SQL
    + """,
calibrated AS (
  SELECT sensor_id, "timestamp", wall, reading_type, battery_level,
         strftime(wall, '%Y-%m-%d') AS date, CAST(extract(hour FROM wall) AS BIGINT) AS hour,
         CASE WHEN reading_type = 'click' THEN value * 1.02 + -1.0 END AS calibrated_value,
         CASE WHEN reading_type = 'click' THEN value * 1.02 + -1.0 ELSE value END AS source_value
  FROM cleaned),
moments AS (
  SELECT reading_type, count(*) AS n, avg(source_value) AS mean,
         stddev_pop(source_value) AS std, median(source_value) AS med
  FROM calibrated GROUP BY reading_type),
flagged AS (
  SELECT c.*, coalesce(n > 10 AND std > 0 AND abs(source_value - mean) / nullif(std, 0) > 3.0, FALSE)
           AS is_outlier, med
  FROM calibrated c JOIN moments m ON c.reading_type = m.reading_type),
replaced AS (
  SELECT * EXCLUDE (med), CASE WHEN is_outlier THEN med ELSE source_value END AS value
  FROM flagged),
enriched AS (
  SELECT *,
    avg(value) OVER (PARTITION BY sensor_id, reading_type, date) AS daily_avg_value,
    CASE WHEN count(value) OVER seven >= 2 THEN avg(value) OVER seven END AS rolling_7day_avg,
    value - lag(value) OVER seq AS value_change,
    datediff('microsecond', lag("timestamp") OVER seq, "timestamp") / 3600000000.0::DOUBLE
      AS time_diff_hours,
    value < CASE reading_type WHEN 'error' THEN 5.0 ELSE 0.0 END
      OR value > CASE reading_type WHEN 'click' THEN 60.0 WHEN 'error' THEN 120.0 ELSE 100.0 END
      AS anomalous_reading,
    battery_level < 0.0 OR battery_level > 100.0 AS battery_anomalous
  FROM replaced
  WINDOW seq AS (PARTITION BY sensor_id, reading_type
                 ORDER BY "timestamp", source_value, battery_level),
         seven AS (PARTITION BY sensor_id, reading_type
                   ORDER BY "timestamp", source_value, battery_level
                   ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""
)


# --- jobs and runs ----------------------------------------------------------------


def _minutes_after(base: str, minutes):
    return F.timestamp_add("MINUTE", minutes, F.expr(f"TIMESTAMP_NTZ '{base}'"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as jobs; states and times by arithmetic on the key."""
    key = F.col("c_custkey")
    names = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("owner")
    )
    due = _minutes_after("2001-08-01 00:00:00", (key * 37) % 2000 - 1000)
    created = _minutes_after("1995-01-01 00:00:00", key * 60)
    schedule = F.element_at(
        F.array(*[F.lit(s) for s in ("Daily", "hourly", "WEEKLY", "0 3 * * *", "daily")]),
        (key % 5 + 1).cast("int"),
    )
    return (
        table(spark, sf_dir, "customer")
        .join(names, "c_nationkey")
        .select(
            key.alias("id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "data_pipeline")
            .otherwise(F.lower("c_mktsegment"))
            .alias("job_type"),
            schedule.alias("schedule"),
            F.when(key % 13 != 0, due).alias("next_run_timestamp"),
            created.alias("created_at"),
            F.timestamp_add("MINUTE", (key * 7919) % 100000, created).alias("updated_at"),
            F.when(key % 4 == 0, "inactive")
            .when(key % 4 == 1, "paused")
            .otherwise("active")
            .alias("status"),
            F.when(key % 6 == 0, F.lit("{}"))
            .otherwise(F.concat(F.lit('{"raw_data_path": "/data/'), key, F.lit('"}')))
            .alias("configuration_parameters"),
            F.concat(F.lit("Job of segment "), F.lower("c_mktsegment")).alias("description"),
            "owner",
        )
    )


JOBS_SQL = """
jobs AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'data_pipeline' ELSE lower(c_mktsegment) END
           AS job_type,
         CASE c_custkey % 5 WHEN 0 THEN 'Daily' WHEN 1 THEN 'hourly' WHEN 2 THEN 'WEEKLY'
              WHEN 3 THEN '0 3 * * *' ELSE 'daily' END AS schedule,
         CASE WHEN c_custkey % 13 <> 0 THEN TIMESTAMP '2001-08-01 00:00:00'
              + ((c_custkey * 37) % 2000 - 1000) * INTERVAL 1 MINUTE END AS next_run_timestamp,
         TIMESTAMP '1995-01-01 00:00:00' + (c_custkey * 60) * INTERVAL 1 MINUTE AS created_at,
         TIMESTAMP '1995-01-01 00:00:00'
           + (c_custkey * 60 + (c_custkey * 7919) % 100000) * INTERVAL 1 MINUTE AS updated_at,
         CASE c_custkey % 4 WHEN 0 THEN 'inactive' WHEN 1 THEN 'paused' ELSE 'active' END AS status,
         CASE WHEN c_custkey % 6 = 0 THEN '{}'
              ELSE '{"raw_data_path": "/data/' || c_custkey || '"}' END AS configuration_parameters,
         'Job of segment ' || lower(c_mktsegment) AS description, n_name AS owner
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def job_runs(spark: SparkSession, sf_dir: str, counts: bool = True) -> DataFrame:
    """``orders`` as runs; the run takes ``o_totalprice`` whole seconds and running ones are open.

    Every ninth open run is only queued. Customers 3, 20, 37, ... never ran: the customer before
    each of them takes its orders over, so all orders are runs of some job.
    """
    key = F.col("o_custkey")
    seconds = F.col("o_totalprice").cast("bigint")
    done = F.col("o_orderstatus") != "O"
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(key % 17 == 3, key - 1).otherwise(key).alias("job_id"),
        F.col("o_orderdate").alias("start_time"),
        F.when(done, F.timestamp_add("SECOND", seconds, F.col("o_orderdate"))).alias("end_time"),
        F.when(F.col("o_orderstatus") == "F", "success")
        .when(F.col("o_orderstatus") == "O", F.when(F.col("o_orderkey") % 9 == 0, "queued").otherwise("running"))
        .otherwise("failed")
        .alias("status"),
        F.when(done, seconds.cast("double")).alias("execution_time_seconds"),
    )
    if not counts:
        return runs
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("records_processed"))
    )
    return runs.join(lines, "id", "left")


RUNS_SQL = """
job_runs AS (
  SELECT o_orderkey AS id, CASE WHEN o_custkey % 17 = 3 THEN o_custkey - 1 ELSE o_custkey END AS job_id,
         o_orderdate AS start_time,
         CASE WHEN o_orderstatus <> 'O'
              THEN o_orderdate + CAST(trunc(o_totalprice) AS BIGINT) * INTERVAL 1 SECOND END
           AS end_time,
         CASE o_orderstatus WHEN 'F' THEN 'success'
              WHEN 'O' THEN CASE WHEN o_orderkey % 9 = 0 THEN 'queued' ELSE 'running' END
              ELSE 'failed' END AS status,
         CASE WHEN o_orderstatus <> 'O' THEN CAST(trunc(o_totalprice) AS DOUBLE) END
           AS execution_time_seconds
  FROM orders)"""


# --- landing folders ---------------------------------------------------------------


def land_by_day(frames: list[DataFrame], label: str) -> str:
    """Write readings as a landing folder with one ``YYYY-MM-DD.parquet`` per UTC day.

    Spark writes one folder per day; the folders then get the landing name. The rename touches
    one path per day and no data. Frames must not share days; their columns may differ. A column ``day``
    overrides the day of the timestamp.
    """
    spark = frames[0].sparkSession
    target = new_path(spark, label)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop_path(target)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(root)
    for frame in frames:
        part = new_path(spark, label + "-days")
        dated = frame if "day" in frame.columns else frame.withColumn("day", utc_day())
        dated.hint("rebalance", F.col("day")).write.partitionBy(
            "day"
        ).parquet(part)
        for entry in fs.listStatus(hadoop_path(part)):
            name = entry.getPath().getName()
            if name.startswith("day="):
                fs.rename(entry.getPath(), hadoop_path(root, f"{name[4:]}.parquet"))
    return target


def utc_day():
    return F.to_date(fx.wall_time(F.col("timestamp"), "UTC")).cast("string")


def landing(spark: SparkSession, sf_dir: str) -> str:
    """The dirty readings as a landing folder, written once per application and table folder while queries use it."""
    return share(spark, "landing", sf_dir, lambda: land_by_day([readings_dirty(spark, sf_dir)], "landing"))


def overlapping_landing(spark: SparkSession, sf_dir: str) -> str:
    """The same, but the readings of a day's last hour lie in the next day's file as well."""
    dirty = readings_dirty(spark, sf_dir)
    wall = fx.wall_time(F.col("timestamp"), "UTC")
    own = F.to_date(wall)
    days = F.when(F.hour(wall) == 23, F.array(own, F.date_add(own, 1))).otherwise(F.array(own))
    twice = dirty.withColumn("day", F.explode(days)).withColumn("day", F.col("day").cast("string"))
    return share(spark, "overlapping-landing", sf_dir, lambda: land_by_day([twice], "overlapping-landing"))


def mixed_landing(spark: SparkSession, sf_dir: str) -> str:
    """The same, but every third day of the month lacks the battery column."""
    dirty = readings_dirty(spark, sf_dir)
    third = F.substring(utc_day(), 9, 2).cast("int") % 3 == 0
    frames = [dirty.where(~third), dirty.where(third).drop("battery_level")]
    return share(spark, "mixed-landing", sf_dir, lambda: land_by_day(frames, "mixed-landing"))
