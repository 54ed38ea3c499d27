"""Registered queries: scans, row-wise steps, aggregates and windows over readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline import functions as fx
from loamline.catalog import bridge as b
from loamline.config import with_calibration, with_range
from loamline.operators import cleaning, outliers, profiles, quality, series
from loamline.plans.transform import transform, transform_stats
from loamline.rows import one_row
from loamline.sources import files, readings

QUERIES = {}
SQL = {}

_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def text(col: str, out: str | None = None):
    """A time column as text, so that both engines compare the same value."""
    return F.date_format(F.col(col), _STAMP).alias(out or col)


def utc_text(col: str = "timestamp"):
    wall = fx.wall_time(F.col(col), "UTC")
    return F.date_format(wall, _STAMP).alias(col)


def sql_text(expr: str, out: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {out}"


TS = sql_text('"timestamp"', '"timestamp"')


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def r6(name: str):
    return F.round(F.col(name), 6).alias(name)


# --- scans -----------------------------------------------------------------------


@query(
    "src_list_files",
    f"WITH {b.DIRTY_SQL} SELECT DISTINCT strftime(\"timestamp\", '%Y-%m-%d') AS day FROM readings_dirty",
)
def _(spark, d):
    listing = files.list_files(spark, b.landing(spark, d))
    day = files.day_of_path(F.col("path")).cast("string").alias("day")
    return listing.where("length > 0").select(day).distinct()


@query(
    "src_date_window",
    f"""WITH {b.DIRTY_SQL}
SELECT strftime("timestamp", '%Y-%m-%d') AS day, count(*) AS records FROM readings_dirty
WHERE "timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-21' GROUP BY 1""",
)
def _(spark, d):
    window = files.read_window(spark, b.landing(spark, d), "2024-01-10", "2024-01-20")
    return window.groupBy(b.utc_day().alias("day")).agg(F.count(F.lit(1)).alias("records"))


@query(
    "src_scan_readings",
    f"WITH {b.DIRTY_SQL} SELECT sensor_id, {TS}, reading_type, value, battery_level FROM readings_dirty",
)
def _(spark, d):
    scan = readings.scan_readings(spark, b.landing(spark, d) + "/*.parquet")
    return scan.select("sensor_id", utc_text(), "reading_type", "value", "battery_level")


@query(
    "src_schema_check",
    f"""WITH {b.DIRTY_SQL}
SELECT strftime("timestamp", '%Y-%m-%d') AS day, count(*) AS num_rows,
       CASE WHEN extract(day FROM min("timestamp")) % 3 = 0 THEN 'battery_level' ELSE '' END AS missing,
       extract(day FROM min("timestamp")) % 3 <> 0 AS is_valid
FROM readings_dirty GROUP BY 1""",
)
def _(spark, d):
    checked = files.schema_check(files.list_files(spark, b.mixed_landing(spark, d)))
    day = files.day_of_path(F.col("path")).cast("string")
    # A day is one or more part files of one write, hence of one schema.
    return checked.groupBy(day.alias("day")).agg(
        F.sum("num_rows").alias("num_rows"),
        F.max(F.array_join("missing", ",")).alias("missing"),
        F.bool_and("is_valid").alias("is_valid"),
    )


@query(
    "src_type_check",
    """
WITH src AS (SELECT user_id, event_type, props, props AS props2 FROM events)
SELECT 'sensor_id' AS "column", 'string' AS expected_type, 'warning' AS severity, 0 AS uncastable_count
UNION ALL SELECT 'reading_type', 'string', 'warning', 0
UNION ALL SELECT 'value', 'double', 'error', count(*) FILTER (TRY_CAST(props AS DOUBLE) IS NULL) FROM src
UNION ALL SELECT 'battery_level', 'double', 'warning',
  count(*) FILTER (TRY_CAST(regexp_extract(props2, '([0-9]+)', 1) AS DOUBLE) IS NULL) FROM src""",
)
def _(spark, d):
    # A malformed feed: the JSON text where the number should be.
    feed = b.table(spark, d, "events").select(
        F.col("user_id").alias("sensor_id"),
        F.col("event_type").alias("reading_type"),
        F.col("props").alias("value"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("battery_level"),
    )
    return readings.type_check(feed).drop("declared_type")


@query(
    "src_file_stats",
    f"""WITH {b.DIRTY_SQL}
SELECT strftime("timestamp", '%Y-%m-%d') AS day, count(*) AS records_total,
       count(*) FILTER (sensor_id IS NOT NULL AND value IS NOT NULL) AS records_valid,
       count(*) FILTER (sensor_id IS NULL OR value IS NULL) AS records_invalid
FROM readings_dirty GROUP BY 1""",
)
def _(spark, d):
    stats = files.ingest(spark, b.landing(spark, d)).stats
    return stats.groupBy(files.day_of_path(F.col("file_path")).cast("string").alias("day")).agg(
        *[F.sum(c).alias(c) for c in ("records_total", "records_valid", "records_invalid")]
    )


@query(
    "src_quarantine",
    f"""WITH {b.DIRTY_SQL}
SELECT strftime("timestamp", '%Y-%m-%d') AS day,
       'Schema validation failed: missing columns battery_level' AS error
FROM readings_dirty WHERE extract(day FROM "timestamp") % 3 = 0 GROUP BY 1""",
)
def _(spark, d):
    bad = files.ingest(spark, b.mixed_landing(spark, d)).quarantined
    day = files.day_of_path(F.col("file_path")).cast("string").alias("day")
    return files.ingest_errors(bad).select(day, "error").distinct()


@query(
    "src_quarantine_kept",
    f"""WITH {b.DIRTY_SQL}
SELECT reading_type, count(*) AS records FROM readings_dirty
WHERE extract(day FROM "timestamp") % 3 <> 0 GROUP BY 1""",
)
def _(spark, d):
    kept = files.ingest(spark, b.mixed_landing(spark, d)).readings
    return kept.groupBy("reading_type").agg(F.count(F.lit(1)).alias("records"))


@query(
    "src_ingest_summary",
    f"""WITH {b.DIRTY_SQL}
SELECT count(*) AS total_records,
       count(*) FILTER (sensor_id IS NOT NULL AND value IS NOT NULL) AS valid_records,
       count(*) FILTER (sensor_id IS NULL OR value IS NULL) AS invalid_records,
       (SELECT count(DISTINCT CAST("timestamp" AS DATE)) FROM readings_dirty WHERE extract(day FROM "timestamp") % 3 <> 0)
         AS successful_days,
       (SELECT count(DISTINCT CAST("timestamp" AS DATE)) FROM readings_dirty WHERE extract(day FROM "timestamp") % 3 = 0)
         AS failed_days,
       TRUE AS files_add_up
FROM readings_dirty WHERE extract(day FROM "timestamp") % 3 <> 0""",
)
def _(spark, d):
    # How many files and bytes a day has is the writer's choice: days are compared, and that the counts add up.
    stats = files.ingest(spark, b.mixed_landing(spark, d)).stats
    day, ok = files.day_of_path(F.col("file_path")), F.col("success")
    days = stats.agg(
        F.count_distinct(F.when(ok, day)).alias("successful_days"), F.count_distinct(F.when(~ok, day)).alias("failed_days")
    )
    told = files.ingest_summary(stats)
    adds_up = (
        (F.col("total_files") == F.col("successful_files") + F.col("failed_files"))
        & (F.col("error_count") == F.col("failed_files"))
        & (F.col("total_size_mb") > 0)
    )
    return one_row(told.withColumn("files_add_up", adds_up), days).select(
        "total_records", "valid_records", "invalid_records", "successful_days", "failed_days", "files_add_up"
    )


@query(
    "src_partition_values",
    """
SELECT DISTINCT event_type AS reading_type, CAST(user_id AS VARCHAR) AS sensor_id FROM events""",
)
def _(spark, d):
    paths = b.readings(spark, d).select(
        F.format_string(
            "/data/reading_type=%s/sensor_id=%s/part-0.parquet", "reading_type", "sensor_id"
        ).alias("p")
    )
    values = files.partition_values(F.col("p"))
    return paths.select(
        values["reading_type"].alias("reading_type"), values["sensor_id"].alias("sensor_id")
    ).distinct()


@query(
    "set_union_all",
    f"""WITH {b.DIRTY_SQL}
SELECT reading_type, count(*) AS records, count(battery_level) AS with_battery FROM (
  SELECT reading_type, battery_level FROM readings_dirty UNION ALL
  SELECT reading_type, NULL FROM readings) GROUP BY 1""",
)
def _(spark, d):
    both = readings.union_readings(
        [b.readings_dirty(spark, d), b.readings(spark, d).drop("battery_level")]
    )
    return both.groupBy("reading_type").agg(
        F.count(F.lit(1)).alias("records"), F.count("battery_level").alias("with_battery")
    )


# --- row-wise steps -----------------------------------------------------------------


def cleaned(spark, d, cfg=b.CONFIG) -> DataFrame:
    return cleaning.clean(cleaning.dedupe(readings.normalise(b.readings_dirty(spark, d))), cfg)


@query(
    "prj_fill_battery",
    f"""WITH {b.DIRTY_SQL}
SELECT sensor_id, {TS}, reading_type, coalesce(battery_level, 100.0) AS battery_level,
       battery_level IS NULL AS was_filled FROM deduped""",
)
def _(spark, d):
    distinct = cleaning.dedupe(readings.normalise(b.readings_dirty(spark, d)))
    marked = distinct.withColumn("was_filled", F.col("battery_level").isNull())
    return cleaning.fill_battery(marked, b.CONFIG).select(
        "sensor_id", utc_text(), "reading_type", "battery_level", "was_filled"
    )


@query(
    "prj_drop_critical",
    f"WITH {b.DIRTY_SQL} SELECT sensor_id, {TS}, reading_type, value, battery_level FROM cleaned",
)
def _(spark, d):
    distinct = cleaning.dedupe(readings.normalise(b.readings_dirty(spark, d)))
    kept = cleaning.drop_critical(cleaning.fill_battery(distinct, b.CONFIG))
    return kept.select("sensor_id", utc_text(), "reading_type", "value", "battery_level")


@query(
    "prj_parse_ts",
    """
SELECT event_id, strftime(CASE event_id % 8 WHEN 0 THEN ts WHEN 1 THEN ts
         WHEN 2 THEN ts - INTERVAL 330 MINUTE WHEN 4 THEN ts - INTERVAL 5 HOUR
         WHEN 5 THEN date_trunc('minute', ts) WHEN 6 THEN date_trunc('second', ts)
         WHEN 7 THEN ts END, '%Y-%m-%d %H:%M:%S.%f') AS parsed
FROM events""",
)
def _(spark, d):
    # Eight spellings: naive, Z, offset, no time at all, hour-only offset, no seconds, basic, UTC.
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = F.col("event_id") % 8
    spelled = (
        F.when(kind == 0, iso)
        .when(kind == 1, F.concat(iso, F.lit("Z")))
        .when(kind == 2, F.concat(iso, F.lit("+05:30")))
        .when(kind == 4, F.concat(iso, F.lit("+05")))
        .when(kind == 5, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(kind == 6, F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
        .when(kind == 7, F.concat(iso, F.lit(" UTC")))
        .otherwise(F.lit("not a time"))
    )
    events = b.table(spark, d, "events").select("event_id", fx.parse_instant(spelled).alias("t"))
    return events.select("event_id", F.date_format(fx.wall_time(F.col("t"), "UTC"), _STAMP).alias("parsed"))


@query(
    "prj_to_zone",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, strftime(wall, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN strftime(wall, '%f') = '000000' THEN '' ELSE '.' || strftime(wall, '%f') END
  || '+05:30' AS local_time FROM readings""",
)
def _(spark, d):
    local = fx.iso_in_zone(F.col("timestamp"), b.CONFIG.target_timezone)
    return b.readings(spark, d, with_id=True).select("event_id", local.alias("local_time"))


@query(
    "prj_date_hour",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, strftime(wall, '%Y-%m-%d') AS date, CAST(extract(hour FROM wall) AS BIGINT) AS hour
FROM readings""",
)
def _(spark, d):
    fields = cleaning.local_fields(b.readings(spark, d, with_id=True), b.CONFIG)
    return fields.select("event_id", "date", F.col("hour").cast("bigint").alias("hour"))


@query(
    "prj_calibrate",
    f"""WITH {b.ENRICHED_SQL}
SELECT sensor_id, {TS}, reading_type, round(source_value, 6) AS value,
       round(calibrated_value, 6) AS calibrated_value FROM calibrated""",
)
def _(spark, d):
    return cleaned(spark, d).select(
        "sensor_id", utc_text(), "reading_type", r6("value"), r6("calibrated_value")
    )


@query(
    "prj_range_anomaly",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, value < CASE reading_type WHEN 'error' THEN 5.0 ELSE 0.0 END
  OR value > CASE reading_type WHEN 'click' THEN 60.0 WHEN 'error' THEN 120.0 ELSE 100.0 END
  AS anomalous_reading FROM readings""",
)
def _(spark, d):
    flagged = cleaning.flag_anomalies(b.readings(spark, d, with_id=True), b.CONFIG)
    return flagged.select("event_id", "anomalous_reading")


@query(
    "prj_battery_anomaly",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, battery_level * 1.5 - 10 < 0 OR battery_level * 1.5 - 10 > 100 AS battery_anomalous
FROM readings""",
)
def _(spark, d):
    # Stretched so that both bounds are crossed.
    stretched = b.readings(spark, d, with_id=True).withColumn(
        "battery_level", F.col("battery_level") * 1.5 - 10
    )
    return cleaning.flag_anomalies(stretched, b.CONFIG).select("event_id", "battery_anomalous")


@query(
    "prj_outlier_flag",
    f"WITH {b.ENRICHED_SQL} SELECT sensor_id, {TS}, reading_type, is_outlier FROM flagged",
)
def _(spark, d):
    rows = cleaned(spark, d)
    flagged = outliers.flag_outliers(rows, outliers.type_moments(rows), b.CONFIG)
    return flagged.select("sensor_id", utc_text(), "reading_type", "is_outlier")


@query(
    "prj_outlier_replace",
    f"""WITH {b.ENRICHED_SQL}
SELECT sensor_id, {TS}, reading_type, is_outlier, round(value, 6) AS value FROM replaced""",
)
def _(spark, d):
    rows = cleaned(spark, d)
    out = outliers.replace_outliers(rows, outliers.type_moments(rows), b.CONFIG)
    return out.select("sensor_id", utc_text(), "reading_type", "is_outlier", r6("value"))


@query(
    "scl_z_score",
    f"""WITH {b.READINGS_SQL},
m AS (SELECT reading_type, avg(value) AS mean, stddev_pop(value) AS sd FROM readings GROUP BY 1)
SELECT event_id, round(CASE WHEN sd = 0 THEN 0.0 ELSE abs((value - mean) / sd) END, 6) AS z
FROM readings JOIN m USING (reading_type)""",
)
def _(spark, d):
    rows = b.readings(spark, d, with_id=True)
    joined = rows.join(outliers.type_moments(rows, approx=True), "reading_type")
    z = fx.z_score(F.col("value"), F.col("mean"), F.col("std"))
    return joined.select("event_id", F.round(z, 6).alias("z"))


@query(
    "scl_safe_divide",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, coalesce(value / nullif(battery_level, 0), -1.0) AS ratio FROM readings""",
)
def _(spark, d):
    ratio = fx.safe_divide(F.col("value"), F.col("battery_level"), -1.0)
    return b.readings(spark, d, with_id=True).select("event_id", ratio.alias("ratio"))


# --- joins ---------------------------------------------------------------------------


@query(
    "join_dim_default",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, (CASE reading_type WHEN 'click' THEN 1.02 ELSE 1.0 END)::DOUBLE AS multiplier,
       (CASE reading_type WHEN 'click' THEN -1.0 ELSE 0.0 END)::DOUBLE AS "offset",
       (CASE reading_type WHEN 'error' THEN 5.0 ELSE 0.0 END)::DOUBLE AS expected_min,
       (CASE reading_type WHEN 'click' THEN 60.0 WHEN 'error' THEN 120.0 ELSE 100.0 END)::DOUBLE
         AS expected_max
FROM readings""",
)
def _(spark, d):
    rows = b.readings(spark, d, with_id=True)
    both = with_range(with_calibration(rows, b.CONFIG), b.CONFIG)
    return both.select("event_id", "multiplier", "offset", "expected_min", "expected_max")


@query(
    "join_daily_avg",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, round(avg(value) OVER (
  PARTITION BY strftime(wall, '%Y-%m-%d'), sensor_id, reading_type), 6) AS daily_avg_value
FROM readings""",
)
def _(spark, d):
    rows = cleaning.local_fields(b.readings(spark, d, with_id=True), b.CONFIG)
    joined = series.series_fields(rows, b.CONFIG, ("daily_avg_value",))
    return joined.select("event_id", r6("daily_avg_value"))


# --- aggregates ------------------------------------------------------------------------


@query(
    "agg_dedupe",
    f"""WITH {b.DIRTY_SQL}
SELECT (SELECT count(*) FROM readings_dirty) AS original_records,
       (SELECT count(*) FROM deduped) AS distinct_records,
       (SELECT count(*) FROM readings_dirty) - (SELECT count(*) FROM deduped) AS duplicates_removed""",
)
def _(spark, d):
    raw = readings.normalise(b.readings_dirty(spark, d))
    return cleaning.dedupe_counts(raw, cleaning.dedupe(raw))


@query(
    "agg_daily_mean",
    f"""WITH {b.READINGS_SQL}
SELECT strftime(wall, '%Y-%m-%d') AS date, sensor_id, reading_type,
       round(avg(value), 6) AS daily_avg_value FROM readings GROUP BY 1, 2, 3""",
)
def _(spark, d):
    rows = cleaning.local_fields(b.readings(spark, d), b.CONFIG)
    return series.daily_means(rows).select(
        "date", "sensor_id", "reading_type", r6("daily_avg_value")
    )


@query(
    "agg_type_moments",
    f"""WITH {b.READINGS_SQL}
SELECT reading_type, count(value) AS n, round(avg(value), 6) AS mean,
       round(stddev_pop(value), 6) AS std, round(median(value), 6) AS median
FROM readings GROUP BY 1""",
)
def _(spark, d):
    moments = outliers.type_moments(b.readings(spark, d))
    return moments.select("reading_type", "n", r6("mean"), r6("std"), r6("median"))


@query(
    "agg_distinct_pairs",
    f"""WITH {b.DIRTY_SQL} SELECT DISTINCT sensor_id, reading_type FROM readings_dirty
WHERE sensor_id IS NOT NULL AND reading_type IS NOT NULL""",
)
def _(spark, d):
    return b.readings_dirty(spark, d).select(*series.SERIES).dropna().distinct()


_PROFILE = """
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, min({c}) AS min, max({c}) AS max,
  round(median({c}), 6) AS median, count(*) - count({c}) AS missing_count,
  round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct FROM src"""
_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "agg_profile",
    """
WITH src AS (SELECT l_quantity, CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS l_extendedprice,
             l_discount, l_tax FROM lineitem)"""
    + " UNION ALL ".join(_PROFILE.format(c=c) for c in _PROFILED),
)
def _(spark, d):
    src = b.table(spark, d, "lineitem").withColumn(
        "l_extendedprice", F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice"))
    )
    out = profiles.profile_columns(src, list(_PROFILED))
    r4 = lambda c: F.round(F.col(c), 4).alias(c)
    return out.select(
        "column", "count", r4("mean"), r4("std"), "min", "max", r6("median"), "missing_count",
        r6("missing_pct"),
    )


@query(
    "agg_transform_stats",
    f"""WITH {b.ENRICHED_SQL}, timeless AS (
  SELECT sensor_id, reading_type, value, battery_level FROM readings WHERE event_id % 13 = 0)
SELECT (SELECT count(*) FROM readings_dirty) + (SELECT count(*) FROM timeless) AS original_records,
  (SELECT count(*) FROM timeless) AS unparsable_times, 'success' AS status,
  (SELECT count(*) FROM cleaned) AS records_after_cleaning,
  (SELECT count(*) FROM cleaned) AS records_after_outlier_removal,
  count(*) AS records_final,
  (SELECT count(*) FROM readings_dirty) - (SELECT count(*) FROM deduped) + (SELECT count(*) FROM timeless)
    - (SELECT count(*) FROM (SELECT DISTINCT * FROM timeless)) AS duplicates_removed,
  (SELECT count(*) FROM deduped WHERE battery_level IS NULL) AS missing_values_filled,
  count(*) FILTER (is_outlier) AS outliers_detected,
  count(*) FILTER (anomalous_reading) + count(*) FILTER (battery_anomalous) AS anomalous_readings,
  'daily_avg_value,rolling_7day_avg,value_change,time_diff_hours' AS derived_fields_added
FROM enriched""",
)
def _(spark, d):
    # Times as text, and rows whose time is no time at all.
    iso = F.date_format(fx.wall_time(F.col("timestamp"), "UTC"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    dirty = b.readings_dirty(spark, d).withColumn("timestamp", iso)
    some = b.readings(spark, d, with_id=True).where(F.col("event_id") % 13 == 0).drop("event_id")
    raw = dirty.unionByName(some.withColumn("timestamp", F.lit("no time")))
    stats = transform_stats(transform(raw, b.CONFIG))
    joined = F.array_join("derived_fields_added", ",")
    return stats.withColumn("derived_fields_added", joined)


# --- windows ---------------------------------------------------------------------------

_SERIES_SQL = "PARTITION BY sensor_id, reading_type ORDER BY \"timestamp\", event_id"


@query(
    "win_rolling_rows",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, round(CASE WHEN count(value) OVER w >= 2 THEN avg(value) OVER w END, 6)
  AS rolling_7day_avg
FROM readings WINDOW w AS ({_SERIES_SQL} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def _(spark, d):
    out = series.series_fields(b.readings(spark, d, with_id=True), b.PLAIN, ("rolling_7day_avg",))
    return out.select("event_id", r6("rolling_7day_avg"))


@query(
    "win_rolling_days",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, round(CASE WHEN count(value) OVER w >= 2 THEN avg(value) OVER w END, 6)
  AS rolling_days_avg
FROM readings WINDOW w AS (PARTITION BY sensor_id, reading_type ORDER BY "timestamp"
  RANGE BETWEEN INTERVAL 604799999999 MICROSECOND PRECEDING AND CURRENT ROW)""",
)
def _(spark, d):
    out = series.rolling_days(b.readings(spark, d, with_id=True), b.PLAIN)
    return out.select("event_id", r6("rolling_days_avg"))


@query(
    "win_value_change",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, round(value - lag(value) OVER ({_SERIES_SQL}), 6) AS value_change FROM readings""",
)
def _(spark, d):
    out = series.series_fields(b.readings(spark, d, with_id=True), b.PLAIN, ("value_change",))
    return out.select("event_id", r6("value_change"))


@query(
    "win_time_diff",
    f"""WITH {b.READINGS_SQL}
SELECT event_id, round(datediff('microsecond', lag("timestamp") OVER ({_SERIES_SQL}), "timestamp")
  / 3600000000.0::DOUBLE, 6) AS time_diff_hours FROM readings""",
)
def _(spark, d):
    out = series.series_fields(b.readings(spark, d, with_id=True), b.PLAIN, ("time_diff_hours",))
    return out.select("event_id", r6("time_diff_hours"))


@query(
    "srt_readings",
    f"WITH {b.READINGS_SQL} SELECT event_id, sensor_id, reading_type, {TS} FROM readings"
    ' ORDER BY sensor_id, reading_type, readings."timestamp", event_id',
)
def _(spark, d):
    ordered = b.readings(spark, d, with_id=True).orderBy(*series.SERIES, "timestamp", "event_id")
    return ordered.select("event_id", "sensor_id", "reading_type", utc_text())


# --- composites ----------------------------------------------------------------------------


@query(
    "cmp_transform",
    f"""WITH {b.ENRICHED_SQL}
SELECT sensor_id, {TS}, reading_type, round(value, 6) AS value, battery_level, date, hour,
  round(calibrated_value, 6) AS calibrated_value, is_outlier,
  round(daily_avg_value, 6) AS daily_avg_value, round(rolling_7day_avg, 6) AS rolling_7day_avg,
  round(value_change, 6) AS value_change, round(time_diff_hours, 6) AS time_diff_hours,
  anomalous_reading, battery_anomalous FROM enriched""",
)
def _(spark, d):
    frame = transform(b.readings_dirty(spark, d), b.CONFIG).frame
    rounded = (
        "value", "calibrated_value", "daily_avg_value", "rolling_7day_avg", "value_change",
        "time_diff_hours",
    )
    return frame.select(
        utc_text(),
        F.col("hour").cast("bigint").alias("hour"),
        *[r6(c) for c in rounded],
        *[c for c in frame.columns if c not in (*rounded, "timestamp", "hour")],
    )


@query(
    "flagship_anomaly_rates",
    f"""WITH {b.ENRICHED_SQL}
SELECT reading_type, count(*) AS total_count,
       count(*) FILTER (anomalous_reading) AS anomalous_count,
       round(count(*) FILTER (anomalous_reading) * 100.0 / count(*), 6) AS anomalous_percentage
FROM enriched GROUP BY 1""",
)
def flagship(spark, d):
    frame = transform(b.readings_dirty(spark, d), b.CONFIG).frame
    rates = quality.anomaly_rates(quality.type_summary(frame, b.CONFIG))
    return rates.withColumn("anomalous_percentage", F.round("anomalous_percentage", 6))
