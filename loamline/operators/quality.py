"""Data-quality sections, one tidy DataFrame each, and the overall score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline import functions as fx
from loamline.config import PipelineConfig, with_range
from loamline.operators.series import SERIES
from loamline.rows import unit
from loamline.sources.readings import READING_COLUMNS, uncastable_counts
from loamline.staging import stage, together

# The declared types accepted for each reading column.
ACCEPTED_TYPES = {
    "sensor_id": (T.StringType, T.VarcharType),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "reading_type": (T.StringType, T.VarcharType),
    "value": (T.DoubleType, T.FloatType, T.DecimalType),
    "battery_level": (T.DoubleType, T.FloatType, T.DecimalType),
}


def type_validity(df: DataFrame) -> DataFrame:
    """(column, actual_type, is_valid, uncastable_count); unknown columns are valid."""
    verdicts = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("actual_type"),
                F.lit(isinstance(f.dataType, ACCEPTED_TYPES.get(f.name, T.DataType))).alias("is_valid"),
            )
            for f in df.schema.fields
        ]
    )
    one = unit(df.sparkSession).select(F.inline(verdicts))
    counts = uncastable_counts(df, READING_COLUMNS).select("column", "uncastable_count")
    # One row per column on both sides.
    return one.join(F.broadcast(counts), "column", "left").withColumn(
        "uncastable_count", F.coalesce("uncastable_count", F.lit(0))
    )


def missing_values(
    df: DataFrame, cfg: PipelineConfig, columns: list[str] | None = None
) -> DataFrame:
    """(column, total_count, missing_count, missing_percentage, is_acceptable): one pass."""
    names = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("total_count"), *_missing_counts(names))
    return _missing_section(counts, names, cfg)


def _missing_counts(names: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(names)]


def _missing_section(counts: DataFrame, names: list[str], cfg: PipelineConfig) -> DataFrame:
    """The section from one row of ``total_count`` and the ``missing_<i>`` counts."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"missing_{i}").alias("missing_count"))
            for i, c in enumerate(names)
        ]
    )
    share = fx.percent(F.col("missing_count"), F.col("total_count"))
    return counts.select("total_count", F.inline(pairs)).select(
        "column",
        "total_count",
        "missing_count",
        share.alias("missing_percentage"),
        (share <= cfg.missing_value_threshold * 100).alias("is_acceptable"),
    )


def type_summary(
    df: DataFrame, cfg: PipelineConfig, missing_columns: list[str] | None = None
) -> DataFrame:
    """Counts per type that range, anomaly and missing-value sections are made of: one pass.

    The range is joined before the grouping, so it costs a map lookup per row and no shuffle.
    """
    value = F.col("value")
    inside = (value >= F.col("expected_min")) & (value <= F.col("expected_max"))
    anomalous = F.col("anomalous_reading") if "anomalous_reading" in df.columns else F.lit(False)
    return (
        with_range(df, cfg)
        .groupBy("reading_type", "expected_min", "expected_max")
        .agg(
            F.min("value").alias("actual_min"),
            F.max("value").alias("actual_max"),
            F.avg("value").alias("actual_avg"),
            F.count(F.lit(1)).alias("total_count"),
            F.count_if(inside).alias("valid_count"),
            F.count_if(anomalous).alias("anomalous_count"),
            *_missing_counts(missing_columns or []),
        )
    )


def value_ranges(summary: DataFrame) -> DataFrame:
    """Range section from :func:`type_summary`; a null value counts as out of range."""
    return summary.where(F.col("reading_type").isNotNull()).select(
        "reading_type",
        "expected_min",
        "expected_max",
        "actual_min",
        "actual_max",
        "actual_avg",
        "total_count",
        "valid_count",
        fx.percent(F.col("valid_count"), F.col("total_count")).alias("valid_percentage"),
        (F.col("total_count") - F.col("valid_count")).alias("out_of_range_count"),
    )


def anomaly_rates(summary: DataFrame) -> DataFrame:
    """Anomaly section from :func:`type_summary`."""
    return summary.where(F.col("reading_type").isNotNull()).select(
        "reading_type",
        "total_count",
        "anomalous_count",
        fx.percent(F.col("anomalous_count"), F.col("total_count")).alias("anomalous_percentage"),
    )


# --- time: coverage and gaps --------------------------------------------------


def active_hours(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """(sensor_id, reading_type, hour_no, readings, first, last) in target-zone wall time.

    The common input of coverage and gaps. It combines map-side, and afterwards no series has
    more rows than its calendar has hours.
    """
    wall = fx.wall_time(F.col("timestamp"), cfg.target_timezone)
    return (
        df.where(F.col("sensor_id").isNotNull() & F.col("reading_type").isNotNull())
        .select(*SERIES, wall.alias("wall"))
        .groupBy(*SERIES, fx.hour_index(F.col("wall")).alias("hour_no"))
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.min("wall").alias("first"),
            F.max("wall").alias("last"),
        )
    )


def series_calendar(hours: DataFrame) -> DataFrame:
    """One row per (sensor, type) that coverage and gap counts are made of.

    ``first_hour`` and ``last_hour`` span whole days; ``active`` counts hours with readings.
    """
    days = hours.groupBy(*SERIES, fx.day_of_hour(F.col("hour_no")).alias("day_no")).agg(
        F.sum("readings").alias("readings"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.count("hour_no").alias("active"),
    )
    return days.groupBy(*SERIES).agg(
        F.sum("readings").alias("reading_count"),
        F.min("first").alias("first_reading"),
        F.max("last").alias("last_reading"),
        F.count("day_no").alias("days_with_data"),
        (F.min("day_no") * 24).alias("first_hour"),
        (F.max("day_no") * 24 + 23).alias("last_hour"),
        F.sum("active").alias("active"),
    )


def time_coverage(calendar: DataFrame) -> DataFrame:
    """Coverage per (sensor, type): calendar days with data over whole elapsed days + 1."""
    span = F.timestamp_diff("DAY", F.col("first_reading"), F.col("last_reading")) + 1
    return calendar.withColumn("time_span_days", F.coalesce(span, F.lit(0))).select(
        *SERIES,
        "reading_count",
        "first_reading",
        "last_reading",
        "time_span_days",
        "days_with_data",
        fx.percent(F.col("days_with_data"), F.col("time_span_days")).alias("coverage_percentage"),
    )


def _bounded(calendar: DataFrame) -> DataFrame:
    return calendar.where(F.col("first_hour").isNotNull())


# Days a row of an expansion holds at most: longer spans become several rows before they are opened.
_DAYS_AT_ONCE = 24


def _each_hour(df: DataFrame, low: str, high: str) -> DataFrame:
    """(sensor, type, hour_no) of every hour from ``low`` to ``high``.

    A span is opened step by step — into stretches, days and hours — so that no array grows with
    it: arrays hold at most the stretches of a span, 24 days and 24 hours.
    """
    for hours in (24 * _DAYS_AT_ONCE**3, 24 * _DAYS_AT_ONCE**2, 24 * _DAYS_AT_ONCE, 24, 1):
        steps = F.sequence(F.col("_low"), F.col("_high"), F.lit(hours).cast("bigint"))
        start = df.select(*SERIES, F.col(low).alias("_low"), F.col(high).alias("_high"))
        opened = start.select(*SERIES, "_high", F.explode(steps).alias("_from"))
        df = opened.select(
            *SERIES, F.col("_from").alias(low), F.least("_high", F.col("_from") + hours - 1).alias(high)
        )
    return df.select(*SERIES, F.col(low).alias("hour_no"))


def expected_hours(hours: DataFrame) -> DataFrame:
    """(sensor, type, hour_no): every hour of each series' calendar."""
    return _each_hour(_bounded(series_calendar(hours)), "first_hour", "last_hour")


def missing_by_anti_join(hours: DataFrame) -> DataFrame:
    """Expected hours without a reading, as an anti join."""
    return expected_hours(hours).join(hours, [*SERIES, "hour_no"], "left_anti")


def gap_spans(hours: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """(sensor, type, from_hour, to_hour): maximal runs of missing hours.

    One row per gap however long it is; only active hours are sorted. ``calendar`` is the
    :func:`series_calendar` of the hours if the caller has it; they need no more than ``hour_no`` then.
    """
    bounds = _bounded(series_calendar(hours) if calendar is None else calendar)
    known = hours.where(F.col("hour_no").isNotNull()).select(*SERIES, "hour_no")
    fences = bounds.select(
        *SERIES, F.explode(F.array(F.col("first_hour") - 1, F.col("last_hour") + 1)).alias("hour_no")
    )
    following = F.lead("hour_no").over(W.partitionBy(*SERIES).orderBy("hour_no"))
    return (
        known.unionByName(fences)
        .withColumn("next_hour", following)
        .where(F.col("next_hour") > F.col("hour_no") + 1)
        .select(
            *SERIES,
            (F.col("hour_no") + 1).alias("from_hour"),
            (F.col("next_hour") - 1).alias("to_hour"),
        )
    )


def gap_hours(hours: DataFrame) -> DataFrame:
    """(sensor, type, missing_hour): one row per missing hour."""
    return _each_hour(gap_spans(hours), "from_hour", "to_hour").select(
        *SERIES, fx.hour_start(F.col("hour_no")).alias("missing_hour")
    )


def gap_span_report(hours: DataFrame) -> DataFrame:
    """(sensor, type, from_hour, to_hour, missing_hours_count) as wall times: one row per gap."""
    return gap_spans(hours).select(
        *SERIES,
        fx.hour_start(F.col("from_hour")).alias("from_hour"),
        fx.hour_start(F.col("to_hour")).alias("to_hour"),
        (F.col("to_hour") - F.col("from_hour") + 1).alias("missing_hours_count"),
    )


def gap_counts(calendar: DataFrame) -> DataFrame:
    """(sensor, type, start_date, end_date, missing_hours_count), by counting alone."""
    date_of = lambda h: F.to_date(fx.hour_start(F.col(h)))
    return _bounded(calendar).select(
        *SERIES,
        date_of("first_hour").alias("start_date"),
        date_of("last_hour").alias("end_date"),
        (F.col("last_hour") - F.col("first_hour") + 1 - F.col("active")).alias(
            "missing_hours_count"
        ),
    )


def gap_report(hours: DataFrame) -> DataFrame:
    """Gap counts plus the sorted list of missing hours of each (sensor, type).

    The list holds every missing hour of a series in one row: a stray time far away makes it long.
    Use it for calendars of known length; reports take :func:`gap_span_report` unless asked.
    """
    starts = lambda a, b: F.sequence(
        fx.hour_start(a), fx.hour_start(b), F.make_dt_interval(hours=F.lit(1))
    )
    lists = (
        gap_spans(hours)
        .groupBy(*SERIES)
        .agg(F.sort_array(F.collect_list(F.struct("from_hour", "to_hour"))).alias("spans"))
        .select(
            *SERIES,
            F.flatten(
                F.transform("spans", lambda s: starts(s["from_hour"], s["to_hour"]))
            ).alias("missing_hours"),
        )
    )
    empty = F.array().cast("array<timestamp_ntz>")
    return (
        gap_counts(series_calendar(hours))
        .join(lists, SERIES, "left")
        .select(
            *SERIES,
            "start_date",
            "end_date",
            F.coalesce("missing_hours", empty).alias("missing_hours"),
            "missing_hours_count",
        )
    )


# --- score ---------------------------------------------------------------------


@dataclass(frozen=True)
class Quality:
    """All sections of one validation. The expensive inputs behind them are staged."""

    data_types: DataFrame
    missing: DataFrame
    ranges: DataFrame
    anomalies: DataFrame
    coverage: DataFrame
    gaps: DataFrame
    hours: DataFrame
    deductions: DataFrame
    score: DataFrame
    totals: DataFrame


def _deduction(df: DataFrame, section: str, key: Column, amount: Column) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"), key.alias("key"), amount.cast("double").alias("deduction")
    )


def deductions(
    missing: DataFrame, ranges: DataFrame, anomalies: DataFrame, gaps: DataFrame
) -> DataFrame:
    """(section, key, deduction): every point the score loses and why."""
    hours = gaps.agg(F.coalesce(F.sum("missing_hours_count"), F.lit(0)).alias("hours"))
    return (
        _deduction(missing.where(~F.col("is_acceptable")), "missing_values", F.col("column"), F.lit(10.0))
        .unionByName(
            _deduction(
                ranges.where(F.col("valid_percentage") < 95.0),
                "value_ranges",
                F.col("reading_type"),
                (F.lit(100.0) - F.col("valid_percentage")) * 0.5,
            )
        )
        .unionByName(
            _deduction(
                anomalies.where(F.col("anomalous_percentage") > 5.0),
                "anomalies",
                F.col("reading_type"),
                F.col("anomalous_percentage") * 0.3,
            )
        )
        .unionByName(
            _deduction(
                hours.where(F.col("hours") > 0),
                "data_gaps",
                F.lit("missing_hours"),
                F.least(F.col("hours") * F.lit(0.1), F.lit(20.0)),
            )
        )
    )


def quality_score(points_lost: DataFrame) -> DataFrame:
    """One row: max(0, 100 − deductions) at two decimals."""
    lost = F.coalesce(F.sum("deduction"), F.lit(0.0))
    return points_lost.agg(
        F.round(F.greatest(F.lit(0.0), F.lit(100.0) - lost), 2).alias("quality_score")
    )


def validate(
    df: DataFrame, cfg: PipelineConfig, missing_columns: list[str] | None = None
) -> Quality:
    """All sections over one frame: three passes, whatever the number of types or sensors.

    Pass a written frame (a table or a staged one): each pass reads only its columns.
    An empty frame is an error.
    """
    names = list(missing_columns or df.columns)
    summary, hours = together(
        lambda: stage(type_summary(df, cfg, names), "type-summary"),
        lambda: stage(active_hours(df, cfg), "active-hours"),
    )
    if summary.isEmpty():
        raise ValueError("no data to validate")
    added = ["total_count", *[f"missing_{i}" for i in range(len(names))]]
    missing = _missing_section(summary.agg(*[F.sum(c).alias(c) for c in added]), names, cfg)
    ranges, anomalies = value_ranges(summary), anomaly_rates(summary)
    calendar = stage(series_calendar(hours), "series-calendar")
    gaps = gap_counts(calendar)
    lost = deductions(missing, ranges, anomalies, gaps)
    return Quality(
        data_types=type_validity(df),
        missing=missing,
        ranges=ranges,
        anomalies=anomalies,
        coverage=time_coverage(calendar),
        gaps=gaps,
        hours=hours,
        deductions=lost,
        score=quality_score(lost),
        totals=missing.select(F.col("total_count").alias("total_records")).limit(1),
    )


def report_rows(q: Quality) -> DataFrame:
    """Long (metric, value, category) form of a validation."""
    # Metric and category texts of the report.
    row = lambda df, metric, value, category: df.select(
        metric.alias("metric"), value.cast("string").alias("value"), F.lit(category).alias("category")
    )
    label = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    text = lambda c: fx.percent_text(F.col(c))
    gap_total = q.gaps.agg(F.coalesce(F.sum("missing_hours_count"), F.lit(0)).alias("hours"))
    parts = [
        row(q.score, F.lit("Overall Quality Score"), F.col("quality_score"), "Overall"),
        row(q.totals, F.lit("Total Records"), F.col("total_records"), "Overall"),
        row(
            q.missing,
            label("Missing Values - ", "column"),
            text("missing_percentage"),
            "Data Completeness",
        ),
        row(
            q.ranges,
            label("Valid Range - ", "reading_type"),
            text("valid_percentage"),
            "Data Accuracy",
        ),
        row(
            q.anomalies,
            label("Anomalous Readings - ", "reading_type"),
            text("anomalous_percentage"),
            "Data Quality",
        ),
        row(gap_total, F.lit("Total Missing Hours"), F.col("hours"), "Data Continuity"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
