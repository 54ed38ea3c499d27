"""Registered queries: sinks (written, then read back) and the whole pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline.catalog import bridge as b
from loamline.catalog.queries_quality import SECTIONS_SQL, enriched
from loamline.catalog.queries_readings import TS, r6, sql_text, utc_text
from loamline.operators import cleaning, quality
from loamline.plans.pipeline import read_table, run_pipeline, stored_calendar
from loamline.sinks import parquet as sink
from loamline.sinks import reports
from loamline.sinks.batches import BatchTable
from loamline.staging import new_path, share

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def dated(spark, d):
    return cleaning.local_fields(b.readings(spark, d), b.CONFIG)


_ROWS = f"""WITH {b.READINGS_SQL}
SELECT sensor_id, {TS}, reading_type, value, battery_level, strftime(wall, '%Y-%m-%d') AS date,
  CAST(extract(hour FROM wall) AS BIGINT) AS hour FROM readings"""


def _shown(df):
    return df.select(
        "sensor_id", utc_text(), "reading_type", "value", "battery_level", "date",
        F.col("hour").cast("bigint").alias("hour"),
    )


@query("snk_single_roundtrip", _ROWS)
def _(spark, d):
    df, path = dated(spark, d), new_path(spark, "single")
    sink.write_single(df, path, "gzip")
    return _shown(sink.read_back(spark, path, df.schema))


@query("snk_partitioned_roundtrip", _ROWS)
def _(spark, d):
    df, path = dated(spark, d), new_path(spark, "partitioned")
    sink.load(df, path, b.CONFIG, partition_by=("date",))
    return _shown(sink.read_back(spark, path, df.schema))


@query(
    "snk_partition_path",
    f"""WITH {b.READINGS_SQL}
SELECT '/store/date=' || strftime(wall, '%Y-%m-%d') || '/place=' || reading_type || '_' || sensor_id
  AS path, count(*) AS rows FROM readings GROUP BY 1""",
)
def _(spark, d):
    placed = dated(spark, d).withColumn("place", F.concat_ws("/", "reading_type", "sensor_id"))
    return sink.partition_manifest(placed, "/store", ["date", "place"])


@query(
    "snk_narrow_plan",
    """
SELECT 'l_orderkey' AS "column", 'bigint' AS from_type, 'int' AS to_type FROM lineitem
  GROUP BY ALL HAVING max(l_orderkey) > 32767
UNION ALL SELECT 'l_orderkey', 'bigint', 'smallint' FROM lineitem HAVING max(l_orderkey) <= 32767
UNION ALL SELECT c, 'bigint', CASE WHEN hi <= 32767 THEN 'smallint' ELSE 'int' END FROM (
  SELECT 'l_partkey' AS c, max(l_partkey) AS hi FROM lineitem
  UNION ALL SELECT 'l_suppkey', max(l_suppkey) FROM lineitem)
UNION ALL SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']), 'double', 'float'
UNION ALL SELECT c, 'string', 'dictionary' FROM (
  SELECT 'l_returnflag' AS c, count(DISTINCT l_returnflag) AS k, count(*) AS n FROM lineitem
  UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus), count(*) FROM lineitem)
  WHERE k < n * 0.5""",
)
def _(spark, d):
    return sink.narrow_plan(b.table(spark, d, "lineitem"))


@query(
    "snk_narrow_cast",
    """
SELECT l_returnflag, count(*) AS lines, CAST(sum(l_orderkey) AS BIGINT) AS keys,
  round(sum(l_tax::FLOAT::DOUBLE), 2) AS tax FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    df = b.table(spark, d, "lineitem")
    slim = sink.narrow(df, sink.narrow_plan(df))
    return slim.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_orderkey").alias("keys"),
        F.round(F.sum(F.col("l_tax").cast("double")), 2).alias("tax"),
    )


_NARROWED_SQL = """CASE WHEN hour < 12 THEN CAST(CAST(value AS FLOAT) AS DOUBLE) WHEN hour < 18 THEN value END"""


@query(
    "snk_narrowed_batches",
    f"""WITH {b.READINGS_SQL}, r AS (
  SELECT *, CAST(extract(hour FROM wall) AS BIGINT) AS hour FROM readings)
SELECT sensor_id, {TS}, reading_type, round({_NARROWED_SQL}, 6) AS value,
  battery_level, strftime(wall, '%Y-%m-%d') AS date, hour FROM r""",
)
def _(spark, d):
    # Full mornings are stored as float; the afternoons have nulls and stay double.
    df, path = dated(spark, d), new_path(spark, "narrowed")
    late = df.where(F.col("hour") >= 12).withColumn("value", F.when(F.col("hour") < 18, F.col("value")))
    for batch, rows in (("am", df.where(F.col("hour") < 12)), ("pm", late)):
        sink.load(rows, path, b.CONFIG, partition_by=("date",), batch=batch, narrowed=True)
    return _shown(sink.read_back(spark, path, df.schema)).withColumn("value", F.round("value", 6))


@query(
    "snk_multi_batch",
    f"""WITH {b.READINGS_SQL} SELECT 2::BIGINT AS total_files, count(*) AS total_records,
  2::BIGINT AS successful_batches, 1::BIGINT AS failed_batches FROM readings""",
)
def _(spark, d):
    df = dated(spark, d)
    halves = [df.where(F.col("hour") < 12), df.where(F.col("hour") >= 12)]
    # A third frame cannot be computed: it fails alone.
    broken = df.withColumn("value", F.raise_error(F.lit("no value")).cast("double"))
    done = sink.load_batches([*halves, broken], new_path(spark, "batch"), b.CONFIG, partition_by=())
    return sink.batch_totals(spark, done).select(
        "total_files", "total_records", "successful_batches", "failed_batches"
    )


@query(
    "snk_load_stats",
    f"""WITH {b.READINGS_SQL}
SELECT count(*) AS records_loaded, count(DISTINCT strftime(wall, '%Y-%m-%d')) AS partition_count
FROM readings""",
)
def _(spark, d):
    df, path = dated(spark, d), new_path(spark, "load")
    sink.load(df, path, b.CONFIG, partition_by=("date",))
    written = sink.read_back(spark, path, df.schema).agg(F.count(F.lit(1)).alias("records_loaded"))
    stats = sink.load_stats(spark, path, len(df.columns), written)
    # Bytes depend on the writer; tests check them on a small table.
    return stats.select("records_loaded", "partition_count")


@query(
    "snk_storage_summary",
    f"WITH {b.READINGS_SQL} SELECT count(*) AS total_records FROM readings",
)
def _(spark, d):
    df, path = dated(spark, d), new_path(spark, "store")
    sink.load(df, path, b.CONFIG, partition_by=("date",))
    return sink.storage_summary(spark, path).select("total_records")


@query(
    "snk_partition_info",
    f"""WITH {b.READINGS_SQL}
SELECT DISTINCT 'date' AS "column", strftime(wall, '%Y-%m-%d') AS value FROM readings
UNION SELECT DISTINCT 'reading_type', reading_type FROM readings""",
)
def _(spark, d):
    df, path = dated(spark, d), new_path(spark, "store")
    sink.load(df, path, b.CONFIG, partition_by=("date", "reading_type"))
    return sink.partition_info(spark, path).select("column", "value")


@query(
    "snk_report_json",
    f"""WITH {SECTIONS_SQL}
SELECT 'value_ranges' AS section, reading_type AS key, total_count::DOUBLE AS n, valid_count::DOUBLE AS m FROM ranges
UNION ALL SELECT 'anomalies', reading_type, total_count, anomalous_count FROM anomalies
UNION ALL SELECT 'missing_values', "column", total_count, missing_count FROM missing
UNION ALL SELECT 'data_gaps', sensor_id || '/' || reading_type, missing_hours_count, NULL FROM gaps
UNION ALL SELECT 'time_coverage', sensor_id || '/' || reading_type, count(*), count(DISTINCT date)
  FROM enriched GROUP BY sensor_id, reading_type
UNION ALL SELECT 'quality_score', NULL, round(greatest(0.0, 100.0 - coalesce(sum(deduction), 0.0)), 2), NULL
  FROM deductions
UNION ALL SELECT 'total_records', NULL, count(*), NULL FROM enriched""",
)
def _(spark, d):
    q = quality.validate(enriched(spark, d), b.CONFIG)
    json_path, _ = reports.write_report(q, new_path(spark, "report"))
    kinds = (
        "reading_type string, sensor_id string, `column` string, total_count double, valid_count double, "
        "anomalous_count double, missing_count double, missing_hours_count double, reading_count double, "
        "days_with_data double, quality_score double, total_records double"
    )
    back = spark.read.schema("section string, body string").json(json_path)
    told = back.select("section", F.from_json("body", kinds).alias("b")).select("section", "b.*")
    # Types of columns and spans of gaps have queries of their own.
    shown = told.where(~F.col("section").isin("data_types", "data_gap_spans"))
    series = F.when(F.col("sensor_id").isNotNull(), F.concat_ws("/", "sensor_id", "reading_type"))
    return shown.select(
        "section",
        F.coalesce(series, "reading_type", "column").alias("key"),
        F.coalesce("missing_hours_count", "reading_count", "quality_score", "total_records", "total_count").alias("n"),
        F.coalesce("valid_count", "anomalous_count", "missing_count", "days_with_data").alias("m"),
    )


@query(
    "cmp_batch_metrics",
    f"""WITH {SECTIONS_SQL}, m AS (
SELECT 'ingest' AS stage, 'total_records' AS metric, count(*)::DOUBLE AS value FROM readings_dirty
UNION ALL SELECT 'ingest', 'valid_records', count(*) FILTER (sensor_id IS NOT NULL AND value IS NOT NULL)
  FROM readings_dirty
UNION ALL SELECT 'ingest', 'invalid_records', count(*) FILTER (sensor_id IS NULL OR value IS NULL)
  FROM readings_dirty
UNION ALL SELECT 'transform', unnest(['records_after_cleaning', 'records_after_outlier_removal']), count(*) FROM cleaned
UNION ALL SELECT 'transform', 'original_records', count(*) FROM readings_dirty
UNION ALL SELECT 'transform', unnest(['unparsable_times', 'duplicates_of_earlier_batches']), 0
UNION ALL SELECT 'ingest', unnest(['failed_files', 'error_count']), 0
UNION ALL SELECT 'transform', 'records_final', count(*) FROM enriched
UNION ALL SELECT 'transform', 'duplicates_removed',
  (SELECT count(*) FROM readings_dirty) - (SELECT count(*) FROM deduped)
UNION ALL SELECT 'transform', 'missing_values_filled', count(*) FROM deduped WHERE battery_level IS NULL
UNION ALL SELECT 'transform', 'outliers_detected', count(*) FILTER (is_outlier) FROM enriched
UNION ALL SELECT 'transform', 'anomalous_readings',
  count(*) FILTER (anomalous_reading) + count(*) FILTER (battery_anomalous) FROM enriched
UNION ALL SELECT 'validate', 'quality_score',
  round(greatest(0.0, 100.0 - coalesce(sum(deduction), 0.0)), 2) FROM deductions
UNION ALL SELECT 'validate', 'total_records', count(*) FROM enriched
UNION ALL SELECT 'load', 'records_loaded', count(*) FROM enriched
UNION ALL SELECT 'load', 'partition_count', count(DISTINCT date) FROM enriched
UNION ALL SELECT unnest(['ingest', 'transform', 'validate', 'load']), 'completed', 1)
SELECT stage, metric, round(value, 2) AS value, CASE metric WHEN 'completed' THEN 'success' END AS status
FROM m""",
)
def _(spark, d):
    done = run_pipeline(
        spark, b.landing(spark, d), new_path(spark, "output"), b.CONFIG, partition_by=("date",)
    )
    # File counts, bytes and ratios are the writer's; the rest is determined by the data.
    told = {
        "records_after_outlier_removal", "original_records", "unparsable_times", "duplicates_of_earlier_batches",
        "failed_files", "error_count", "total_records", "valid_records", "invalid_records", "records_after_cleaning", "records_final",
        "duplicates_removed", "missing_values_filled", "outliers_detected", "anomalous_readings",
        "quality_score", "records_loaded", "partition_count", "completed",
    }
    shown = done.metrics.where(F.col("metric").isin(*sorted(told)))
    return shown.select("stage", "metric", F.round("value", 2).alias("value"), "status")


@query(
    "cmp_batch_output",
    f"""WITH {b.ENRICHED_SQL}
SELECT sensor_id, {TS}, reading_type, round(value, 6) AS value, is_outlier, anomalous_reading
FROM enriched WHERE "timestamp" >= TIMESTAMP '2024-01-01'""",
)
def _(spark, d):
    done = run_pipeline(
        spark, b.landing(spark, d), new_path(spark, "output"), b.CONFIG, "2024-01-01", "2024-01-31",
        validate_output=False, partition_by=("date",),
    )
    return done.output.select(
        "sensor_id", utc_text(), "reading_type", r6("value"), "is_outlier", "anomalous_reading"
    )


# --- tables of several batches ------------------------------------------------------------


def _batches_sql(landed: str, batch: str, until: str) -> str:
    """The enriched rows of a table that was loaded batch by batch, decided batch by batch with all rows so far.

    ``landed`` are the landed rows with their file's day, ``batch`` numbers the batches by that day.
    """
    return f"""{b.DIRTY_SQL}, landed AS ({landed}),
numbered AS (SELECT * EXCLUDE (file_day), {batch} AS batch FROM landed WHERE {until}),
first_seen AS (
  SELECT sensor_id, "timestamp", wall, reading_type, value, battery_level, min(batch) AS batch
  FROM numbered GROUP BY ALL),
b_calibrated AS (
  SELECT sensor_id, "timestamp", wall, reading_type, coalesce(battery_level, 100.0) AS battery_level, batch,
         strftime(wall, '%Y-%m-%d') AS date, CAST(extract(hour FROM wall) AS BIGINT) AS hour,
         CASE WHEN reading_type = 'click' THEN value * 1.02 + -1.0 END AS calibrated_value,
         CASE WHEN reading_type = 'click' THEN value * 1.02 + -1.0 ELSE value END AS source_value
  FROM first_seen WHERE sensor_id IS NOT NULL AND "timestamp" IS NOT NULL AND reading_type IS NOT NULL
    AND value IS NOT NULL),
b_moments AS (
  SELECT n.batch, reading_type, count(*) AS n, avg(source_value) AS mean, stddev_pop(source_value) AS std,
         median(source_value) AS med
  FROM b_calibrated c JOIN (SELECT DISTINCT batch FROM b_calibrated) n ON c.batch <= n.batch GROUP BY ALL),
b_flagged AS (
  SELECT c.*, coalesce(n > 10 AND std > 0 AND abs(source_value - mean) / nullif(std, 0) > 3.0, FALSE)
           AS is_outlier, med
  FROM b_calibrated c JOIN b_moments m ON c.reading_type = m.reading_type AND c.batch = m.batch),
b_replaced AS (SELECT *, CASE WHEN is_outlier THEN med ELSE source_value END AS value FROM b_flagged),
b_enriched AS (
  SELECT *,
    avg(value) OVER (PARTITION BY sensor_id, reading_type, date) AS daily_avg_value,
    CASE WHEN count(value) OVER seven >= 2 THEN avg(value) OVER seven END AS rolling_7day_avg,
    CASE WHEN count(value) OVER span >= 2 THEN avg(value) OVER span END AS rolling_days_avg,
    value - lag(value) OVER seq AS value_change,
    datediff('microsecond', lag("timestamp") OVER seq, "timestamp") / 3600000000.0::DOUBLE AS time_diff_hours,
    value < CASE reading_type WHEN 'error' THEN 5.0 ELSE 0.0 END
      OR value > CASE reading_type WHEN 'click' THEN 60.0 WHEN 'error' THEN 120.0 ELSE 100.0 END
      AS anomalous_reading,
    battery_level < 0.0 OR battery_level > 100.0 AS battery_anomalous
  FROM b_replaced
  WINDOW seq AS (PARTITION BY sensor_id, reading_type ORDER BY "timestamp", source_value, battery_level),
         seven AS (PARTITION BY sensor_id, reading_type ORDER BY "timestamp", source_value, battery_level
                   ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         span AS (PARTITION BY sensor_id, reading_type ORDER BY "timestamp"
                  RANGE BETWEEN INTERVAL 604799999999 MICROSECOND PRECEDING AND CURRENT ROW))"""


_ROUNDED = (
    "value", "calibrated_value", "daily_avg_value", "rolling_7day_avg", "value_change", "time_diff_hours",
)
_ALL_SQL = (
    f"sensor_id, {TS}, reading_type, battery_level, date, hour, is_outlier, anomalous_reading, battery_anomalous, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _ROUNDED)
)


def _all_columns(table, *extra):
    kept = ("battery_level", "date", "is_outlier", "anomalous_reading", "battery_anomalous")
    return table.select(
        "sensor_id", utc_text(), "reading_type", *kept, F.col("hour").cast("bigint").alias("hour"),
        *[r6(c) for c in (*_ROUNDED, *extra)],
    )


_DAILY_SQL = _batches_sql(
    """SELECT sensor_id, "timestamp", wall, reading_type, value, battery_level, date_trunc('day', "timestamp") AS file_day
  FROM readings_dirty""",
    "file_day",
    "file_day >= TIMESTAMP '2024-01-10' AND file_day < TIMESTAMP '2024-01-13'",
)


@query("cmp_batch_daily_loads", f"WITH {_DAILY_SQL} SELECT {_ALL_SQL} FROM b_enriched")
def _(spark, d):
    # Adjacent days into one table, one of them twice, in the default layout.
    landed, path = b.landing(spark, d), new_path(spark, "daily")
    for day in ("2024-01-10", "2024-01-11", "2024-01-12", "2024-01-11"):
        done = run_pipeline(spark, landed, path, b.CONFIG, day, day, validate_output=False)
    return _all_columns(read_table(spark, path, done.output.schema))


# Three batches whose files share the last hours of days; the middle one is loaded twice. They are longer than
# the day span, so rows leave it.
_WINDOWS = (("2024-01-01", "2024-01-05"), ("2024-01-06", "2024-01-11"), ("2024-01-12", "2024-01-16"))
_BORDERS_SQL = _batches_sql(
    """SELECT sensor_id, "timestamp", wall, reading_type, value, battery_level,
         date_trunc('day', "timestamp") AS file_day FROM readings_dirty
  UNION ALL SELECT sensor_id, "timestamp", wall, reading_type, value, battery_level,
         date_trunc('day', "timestamp") + INTERVAL 1 DAY FROM readings_dirty WHERE extract(hour FROM "timestamp") = 23""",
    "CASE WHEN file_day <= TIMESTAMP '2024-01-05' THEN 1 WHEN file_day <= TIMESTAMP '2024-01-11' THEN 2 ELSE 3 END",
    "file_day <= TIMESTAMP '2024-01-16'",
)

def batches_table(spark, d):
    """(path, schema) of that table, loaded once per application and table folder while queries use it."""

    def loaded():
        landed, path = b.overlapping_landing(spark, d), new_path(spark, "batches")
        for start, end in (*_WINDOWS[:2], _WINDOWS[2], _WINDOWS[1]):
            run_pipeline(spark, landed, path, b.CONFIG, start, end, validate_output=False, day_span=True)
        return path

    path = share(spark, "batches", d, loaded)
    stored = next(iter(BatchTable(spark, path).entries().values())).types
    return path, T.StructType.fromDDL(", ".join(f"`{c}` {kind}" for c, kind in stored.items()))


@query(
    "cmp_batch_history",
    f"WITH {_BORDERS_SQL} SELECT {_ALL_SQL}, round(rolling_days_avg, 6) AS rolling_days_avg FROM b_enriched",
)
def _(spark, d):
    return _all_columns(read_table(spark, *batches_table(spark, d)), "rolling_days_avg")


@query(
    "agg_stored_coverage",
    f"""WITH {_BORDERS_SQL}, c AS (
SELECT sensor_id, reading_type, count(*) AS reading_count, min(wall) AS first, max(wall) AS last,
  CAST(floor(datediff('microsecond', min(wall), max(wall)) / 86400000000) AS BIGINT) + 1 AS time_span_days,
  count(DISTINCT date) AS days_with_data FROM b_enriched GROUP BY 1, 2)
SELECT sensor_id, reading_type, reading_count, {sql_text('first', 'first_reading')},
  {sql_text('last', 'last_reading')}, time_span_days, days_with_data,
  round(days_with_data * 100.0 / time_span_days, 6) AS coverage_percentage FROM c""",
)
def _(spark, d):
    calendar, _ = stored_calendar(spark, batches_table(spark, d)[0])
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return quality.time_coverage(calendar).select(
        "sensor_id", "reading_type", "reading_count", text("first_reading"), text("last_reading"),
        "time_span_days", "days_with_data", r6("coverage_percentage"),
    )


@query(
    "gen_stored_gap_spans",
    f"""WITH {_BORDERS_SQL}, active AS (
  SELECT DISTINCT sensor_id, reading_type, date_trunc('hour', wall) AS h FROM b_enriched),
bounds AS (
  SELECT sensor_id, reading_type, min(date_trunc('day', h)) AS lo, max(date_trunc('day', h)) + INTERVAL 23 HOUR AS hi
  FROM active GROUP BY 1, 2),
missing AS (
  SELECT sensor_id, reading_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h FROM bounds
  EXCEPT SELECT sensor_id, reading_type, h FROM active),
runs AS (
  SELECT *, h - row_number() OVER (PARTITION BY sensor_id, reading_type ORDER BY h) * INTERVAL 1 HOUR AS run FROM missing)
SELECT sensor_id, reading_type, datediff('hour', TIMESTAMP '1970-01-01', min(h)) AS from_hour,
  datediff('hour', TIMESTAMP '1970-01-01', max(h)) AS to_hour FROM runs GROUP BY sensor_id, reading_type, run""",
)
def _(spark, d):
    calendar, hours = stored_calendar(spark, batches_table(spark, d)[0])
    return quality.gap_spans(hours, calendar)
