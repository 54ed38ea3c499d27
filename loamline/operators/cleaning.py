"""Row cleaning and per-row fields: dedupe, fills, drops, time zone, calibration, ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline import functions as fx
from loamline.config import PipelineConfig, with_calibration, with_range
from loamline.rows import one_row
from loamline.sources.readings import all_present


def dedupe(df: DataFrame) -> DataFrame:
    """Drop full-row copies (nulls equal).

    Copies collapse map-side before the shuffle, which hashes the whole row, so a mass of
    identical rows reaches a reducer as at most one row per map task.
    """
    return df.dropDuplicates()


def dedupe_counts(raw: DataFrame, distinct: DataFrame) -> DataFrame:
    """One row: records before and after :func:`dedupe`, and the number removed."""
    return one_row(
        raw.agg(F.count(F.lit(1)).alias("original_records")),
        distinct.agg(F.count(F.lit(1)).alias("distinct_records")),
    ).withColumn(
        "duplicates_removed", F.col("original_records") - F.col("distinct_records")
    )


def fill_battery(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return df.fillna({"battery_level": cfg.default_battery})


def drop_critical(df: DataFrame) -> DataFrame:
    """Drop rows lacking any of sensor, time, type or value."""
    return df.where(all_present())


def local_fields(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """``date`` (text) and ``hour`` of the target-zone wall time."""
    wall = fx.wall_time(F.col("timestamp"), cfg.target_timezone)
    return df.withColumns(
        {"date": F.to_date(wall).cast("string"), "hour": F.hour(wall).cast("int")}
    )


def calibrate(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """``value * multiplier + offset`` by type.

    ``calibrated_value`` exists only when some type has a non-identity calibration, and is
    null for identity types.
    """
    if not cfg.calibrates:
        return df
    joined = with_calibration(df, cfg)
    changed = (F.col("multiplier") != 1.0) | (F.col("offset") != 0.0)
    scaled = F.col("value") * F.col("multiplier") + F.col("offset")
    return (
        joined.withColumn("calibrated_value", F.when(changed, scaled))
        .withColumn("value", F.coalesce("calibrated_value", "value"))
        .drop("multiplier", "offset")
    )


def flag_anomalies(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """``anomalous_reading`` and ``battery_anomalous``: strictly outside the range."""
    value, battery = F.col("value"), F.col("battery_level")
    low, high = cfg.battery_range.low, cfg.battery_range.high
    outside = (value < F.col("expected_min")) | (value > F.col("expected_max"))
    return (
        with_range(df, cfg)
        .withColumns(
            {
                "anomalous_reading": F.coalesce(outside, F.lit(False)),
                "battery_anomalous": F.coalesce((battery < low) | (battery > high), F.lit(False)),
            }
        )
        .drop("expected_min", "expected_max")
    )


def clean(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """All row-wise steps on de-duplicated rows: no shuffle, one codegen span."""
    return calibrate(local_fields(drop_critical(fill_battery(df, cfg)), cfg), cfg)
