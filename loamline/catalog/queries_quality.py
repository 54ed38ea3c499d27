"""Registered queries: quality sections, gaps and the score."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamline import functions as fx
from loamline.catalog import bridge as b
from loamline.catalog.queries_readings import r6, sql_text, text
from loamline.operators import quality
from loamline.operators.cleaning import flag_anomalies
from loamline.plans.transform import transform
from loamline.sources import readings
from loamline.staging import stage

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def enriched(spark, d):
    """The enriched readings, written once per query as the pipeline does."""
    return stage(transform(b.readings_dirty(spark, d), b.CONFIG).frame, "enriched")


def hours(spark, d):
    return stage(quality.active_hours(b.readings(spark, d), b.CONFIG), "active-hours")


# The sections as SQL over ``enriched``.
_COLUMNS = (
    "sensor_id", '"timestamp"', "reading_type", "value", "battery_level", "date", "hour",
    "calibrated_value", "is_outlier", "daily_avg_value", "rolling_7day_avg", "value_change",
    "time_diff_hours", "anomalous_reading", "battery_anomalous",
)
_MISSING = " UNION ALL ".join(
    f"""SELECT '{c.strip('"')}' AS "column", count(*) AS total_count,
  count(*) - count({c}) AS missing_count,
  (count(*) - count({c})) * 100.0 / count(*) AS missing_percentage,
  (count(*) - count({c})) * 100.0 / count(*) <= 10.0 AS is_acceptable FROM enriched"""
    for c in _COLUMNS
)
_RANGES = """
SELECT reading_type, (CASE reading_type WHEN 'error' THEN 5.0 ELSE 0.0 END)::DOUBLE AS expected_min,
  (CASE reading_type WHEN 'click' THEN 60.0 WHEN 'error' THEN 120.0 ELSE 100.0 END)::DOUBLE
    AS expected_max,
  min(value) AS actual_min, max(value) AS actual_max, avg(value) AS actual_avg,
  count(*) AS total_count,
  count(*) FILTER (value BETWEEN CASE reading_type WHEN 'error' THEN 5.0 ELSE 0.0 END
    AND CASE reading_type WHEN 'click' THEN 60.0 WHEN 'error' THEN 120.0 ELSE 100.0 END) AS valid_count
FROM enriched GROUP BY 1"""
_ANOMALIES = """
SELECT reading_type, count(*) AS total_count, count(*) FILTER (anomalous_reading) AS anomalous_count,
  count(*) FILTER (anomalous_reading) * 100.0 / count(*) AS anomalous_percentage
FROM enriched GROUP BY 1"""
_GAPS = """
SELECT sensor_id, reading_type, min(CAST(wall AS DATE)) AS start_date, max(CAST(wall AS DATE)) AS end_date,
  (datediff('day', min(CAST(wall AS DATE)), max(CAST(wall AS DATE))) + 1) * 24
    - count(DISTINCT date_trunc('hour', wall)) AS missing_hours_count
FROM {source} GROUP BY 1, 2"""
SECTIONS_SQL = (
    b.ENRICHED_SQL
    + f""",
missing AS ({_MISSING}),
ranges AS (SELECT *, valid_count * 100.0 / total_count AS valid_percentage,
           total_count - valid_count AS out_of_range_count FROM ({_RANGES})),
anomalies AS ({_ANOMALIES}),
gaps AS ({_GAPS.format(source="enriched")}),
deductions AS (
  SELECT 'missing_values' AS section, "column" AS key, 10.0 AS deduction FROM missing
    WHERE NOT is_acceptable
  UNION ALL SELECT 'value_ranges', reading_type, (100.0 - valid_percentage) * 0.5 FROM ranges
    WHERE valid_percentage < 95.0
  UNION ALL SELECT 'anomalies', reading_type, anomalous_percentage * 0.3 FROM anomalies
    WHERE anomalous_percentage > 5.0
  UNION ALL SELECT 'data_gaps', 'missing_hours', least(sum(missing_hours_count) * 0.1, 20.0)
    FROM gaps HAVING sum(missing_hours_count) > 0)"""
)


@query(
    "prj_type_validity",
    """
SELECT 'sensor_id' AS "column", 'bigint' AS actual_type, FALSE AS is_valid, 0 AS uncastable_count
UNION ALL SELECT 'timestamp', 'timestamp_ntz', TRUE, 0
UNION ALL SELECT 'reading_type', 'string', TRUE, 0
UNION ALL SELECT 'value', 'string', FALSE, count(*) FILTER (TRY_CAST(props AS DOUBLE) IS NULL) FROM events
UNION ALL SELECT 'battery_level', 'double', TRUE, 0
UNION ALL SELECT 'note', 'bigint', TRUE, 0""",
)
def _(spark, d):
    feed = b.table(spark, d, "events").select(
        F.col("user_id").alias("sensor_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("reading_type"),
        F.col("props").alias("value"),
        F.col("value").alias("battery_level"),
        F.col("event_id").alias("note"),
    )
    return quality.type_validity(feed)


@query(
    "agg_value_ranges",
    f"""WITH {SECTIONS_SQL}
SELECT reading_type, expected_min, expected_max, round(actual_min, 6) AS actual_min,
  round(actual_max, 6) AS actual_max, round(actual_avg, 6) AS actual_avg, total_count, valid_count,
  round(valid_percentage, 6) AS valid_percentage, out_of_range_count FROM ranges""",
)
def _(spark, d):
    frame = transform(b.readings_dirty(spark, d), b.CONFIG).frame
    out = quality.value_ranges(quality.type_summary(frame, b.CONFIG))
    rounded = ("actual_min", "actual_max", "actual_avg", "valid_percentage")
    return out.select(*[c for c in out.columns if c not in rounded], *[r6(c) for c in rounded])


@query(
    "agg_missing_values",
    f"""WITH {SECTIONS_SQL}
SELECT "column", total_count, missing_count, round(missing_percentage, 6) AS missing_percentage,
  is_acceptable FROM missing""",
)
def _(spark, d):
    frame = transform(b.readings_dirty(spark, d), b.CONFIG).frame
    out = quality.missing_values(frame, b.CONFIG)
    return out.withColumn("missing_percentage", F.round("missing_percentage", 6))


@query(
    "agg_anomaly_rate",
    f"""WITH {b.READINGS_SQL},
flagged AS (SELECT reading_type, value < CASE reading_type WHEN 'error' THEN 5.0 ELSE 0.0 END
  OR value > CASE reading_type WHEN 'click' THEN 60.0 WHEN 'error' THEN 120.0 ELSE 100.0 END AS bad
  FROM readings)
SELECT reading_type, count(*) AS total_count, count(*) FILTER (bad) AS anomalous_count,
  round(count(*) FILTER (bad) * 100.0 / count(*), 6) AS anomalous_percentage
FROM flagged GROUP BY 1""",
)
def _(spark, d):
    flagged = flag_anomalies(b.readings(spark, d), b.CONFIG)
    out = quality.anomaly_rates(quality.type_summary(flagged, b.CONFIG))
    return out.withColumn("anomalous_percentage", F.round("anomalous_percentage", 6))


@query(
    "agg_time_coverage",
    f"""WITH {b.READINGS_SQL}, c AS (
SELECT sensor_id, reading_type, count(*) AS reading_count, min(wall) AS first, max(wall) AS last,
  CAST(floor(datediff('microsecond', min(wall), max(wall)) / 86400000000) AS BIGINT) + 1
    AS time_span_days,
  count(DISTINCT CAST(wall AS DATE)) AS days_with_data
FROM readings GROUP BY 1, 2)
SELECT sensor_id, reading_type, reading_count, {sql_text('first', 'first_reading')},
  {sql_text('last', 'last_reading')}, time_span_days, days_with_data,
  round(days_with_data * 100.0 / time_span_days, 6) AS coverage_percentage FROM c""",
)
def _(spark, d):
    active = quality.active_hours(b.readings(spark, d), b.CONFIG)
    out = quality.time_coverage(quality.series_calendar(active))
    return out.select(
        "sensor_id", "reading_type", "reading_count", text("first_reading"), text("last_reading"),
        "time_span_days", "days_with_data", r6("coverage_percentage"),
    )


# --- gaps ---------------------------------------------------------------------------

_EXPECTED = f"""WITH {b.READINGS_SQL},
actual AS (SELECT DISTINCT sensor_id, reading_type, date_trunc('hour', wall) AS h FROM readings),
bounds AS (SELECT sensor_id, reading_type, date_trunc('day', min(h)) AS lo,
           date_trunc('day', max(h)) + INTERVAL 23 HOUR AS hi FROM actual GROUP BY 1, 2),
expected AS (SELECT sensor_id, reading_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h
             FROM bounds),
missing_hour AS (SELECT * FROM expected e ANTI JOIN actual a
             ON e.sensor_id = a.sensor_id AND e.reading_type = a.reading_type AND e.h = a.h)"""


@query(
    "gen_expected_hours",
    f"{_EXPECTED} SELECT sensor_id, reading_type, {sql_text('h', 'hour')} FROM expected",
)
def _(spark, d):
    out = quality.expected_hours(hours(spark, d))
    return out.select("sensor_id", "reading_type", _hour_text("hour"))


def _hour_text(name: str):
    return F.date_format(fx.hour_start(F.col("hour_no")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


@query(
    "join_gap_anti",
    f"{_EXPECTED} SELECT sensor_id, reading_type, {sql_text('h', 'missing_hour')} FROM missing_hour",
)
def _(spark, d):
    out = quality.missing_by_anti_join(hours(spark, d))
    return out.select("sensor_id", "reading_type", _hour_text("missing_hour"))


@query(
    "gen_gap_hours",
    f"{_EXPECTED} SELECT sensor_id, reading_type, {sql_text('h', 'missing_hour')} FROM missing_hour",
)
def _(spark, d):
    out = quality.gap_hours(hours(spark, d))
    return out.select("sensor_id", "reading_type", text("missing_hour"))


@query(
    "gen_gap_spans",
    f"""{_EXPECTED}, numbered AS (
  SELECT *, h - row_number() OVER (PARTITION BY sensor_id, reading_type ORDER BY h) * INTERVAL 1 HOUR AS run
  FROM missing_hour)
SELECT sensor_id, reading_type, strftime(min(h), '%Y-%m-%d %H:%M:%S') AS from_hour,
       strftime(max(h), '%Y-%m-%d %H:%M:%S') AS to_hour, count(*) AS missing_hours_count
FROM numbered GROUP BY sensor_id, reading_type, run""",
)
def _(spark, d):
    out = quality.gap_span_report(hours(spark, d))
    return out.withColumns({c: F.col(c).cast("string") for c in ("from_hour", "to_hour")})


@query(
    "gen_gap_report",
    f"""{_EXPECTED}, lists AS (
  SELECT sensor_id, reading_type, string_agg(strftime(h, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY h) AS hours,
         count(*) AS n FROM missing_hour GROUP BY 1, 2)
SELECT b.sensor_id, b.reading_type, strftime(lo, '%Y-%m-%d') AS start_date,
       strftime(hi, '%Y-%m-%d') AS end_date, coalesce(hours, '') AS missing_hours,
       coalesce(n, 0) AS missing_hours_count
FROM bounds b LEFT JOIN lists l ON b.sensor_id = l.sensor_id AND b.reading_type = l.reading_type""",
)
def _(spark, d):
    out = quality.gap_report(hours(spark, d))
    listed = F.col("missing_hours").cast("array<string>")
    return out.select(
        "sensor_id",
        "reading_type",
        F.col("start_date").cast("string").alias("start_date"),
        F.col("end_date").cast("string").alias("end_date"),
        F.array_join(listed, ",").alias("missing_hours"),
        "missing_hours_count",
    )


# --- score -----------------------------------------------------------------------------


@query(
    "agg_deductions",
    f"WITH {SECTIONS_SQL} SELECT section, key, round(deduction, 6) AS deduction FROM deductions",
)
def _(spark, d):
    return quality.validate(enriched(spark, d), b.CONFIG).deductions.select(
        "section", "key", r6("deduction")
    )


@query(
    "agg_quality_score",
    f"""WITH {SECTIONS_SQL}
SELECT round(greatest(0.0, 100.0 - coalesce(sum(deduction), 0.0)), 2)::DOUBLE AS quality_score
FROM deductions""",
)
def _(spark, d):
    return quality.validate(enriched(spark, d), b.CONFIG).score


@query(
    "agg_quality_score_raw_columns",
    f"""WITH {SECTIONS_SQL}
SELECT round(greatest(0.0, 100.0 - coalesce(sum(deduction), 0.0)), 2)::DOUBLE AS quality_score
FROM deductions WHERE section <> 'missing_values' OR key IN ('sensor_id', 'value')""",
)
def _(spark, d):
    return quality.validate(enriched(spark, d), b.CONFIG, ["sensor_id", "value"]).score


_REPORT = """
SELECT 'Overall Quality Score' AS metric, CAST((SELECT round(greatest(0.0, 100.0
  - coalesce(sum(deduction), 0.0)), 2)::DOUBLE FROM deductions) AS VARCHAR) AS value, 'Overall' AS category
UNION ALL SELECT 'Total Records', CAST(count(*) AS VARCHAR), 'Overall' FROM enriched
UNION ALL SELECT 'Missing Values - ' || "column", printf('%.2f%%', missing_percentage::DOUBLE),
  'Data Completeness' FROM missing
UNION ALL SELECT 'Valid Range - ' || reading_type, printf('%.2f%%', valid_percentage::DOUBLE),
  'Data Accuracy' FROM ranges
UNION ALL SELECT 'Anomalous Readings - ' || reading_type, printf('%.2f%%', anomalous_percentage::DOUBLE),
  'Data Quality' FROM anomalies
UNION ALL SELECT 'Total Missing Hours', CAST(CAST(sum(missing_hours_count) AS BIGINT) AS VARCHAR),
  'Data Continuity' FROM gaps"""


@query("snk_report_rows", f"WITH {SECTIONS_SQL} {_REPORT}")
def _(spark, d):
    return quality.report_rows(quality.validate(enriched(spark, d), b.CONFIG))


@query(
    "cmp_quality_sections",
    f"""WITH {SECTIONS_SQL}
SELECT 'missing_values' AS section, count(*) AS findings, CAST(sum(missing_count) AS BIGINT) AS total
FROM missing
UNION ALL SELECT 'value_ranges', count(*), CAST(sum(valid_count) AS BIGINT) FROM ranges
UNION ALL SELECT 'anomalies', count(*), CAST(sum(anomalous_count) AS BIGINT) FROM anomalies
UNION ALL SELECT 'data_gaps', count(*), CAST(sum(missing_hours_count) AS BIGINT) FROM gaps
UNION ALL SELECT 'time_coverage', count(*), CAST(sum(n) AS BIGINT) FROM (
  SELECT count(DISTINCT CAST(wall AS DATE)) AS n FROM enriched GROUP BY sensor_id, reading_type)
UNION ALL SELECT 'data_types', 15, 15""",
)
def _(spark, d):
    q = quality.validate(enriched(spark, d), b.CONFIG)
    parts = (
        ("missing_values", q.missing, F.col("missing_count")),
        ("value_ranges", q.ranges, F.col("valid_count")),
        ("anomalies", q.anomalies, F.col("anomalous_count")),
        ("data_gaps", q.gaps, F.col("missing_hours_count")),
        ("time_coverage", q.coverage, F.col("days_with_data")),
        ("data_types", q.data_types, F.col("is_valid").cast("bigint")),
    )
    rows = [
        df.select(F.lit(name).alias("section"), amount.alias("amount")) for name, df, amount in parts
    ]
    return (
        readings.union_readings(rows)
        .groupBy("section")
        .agg(F.count(F.lit(1)).alias("findings"), F.sum("amount").alias("total"))
    )
