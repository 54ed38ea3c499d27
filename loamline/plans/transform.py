"""The six-step enrichment of raw readings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline import functions as fx
from loamline.config import PipelineConfig
from loamline.operators import cleaning, history, outliers, series
from loamline.rows import one_row
from loamline.sources.readings import (
    READING_COLUMNS,
    SPELLING,
    all_present,
    keep_spelling,
    normalise,
)
from loamline.staging import stage, together

ENRICHED_COLUMNS = (
    "sensor_id",
    "timestamp",
    "reading_type",
    "value",
    "battery_level",
    "date",
    "hour",
    "calibrated_value",
    "is_outlier",
    "daily_avg_value",
    "rolling_7day_avg",
    "value_change",
    "time_diff_hours",
    "anomalous_reading",
    "battery_anomalous",
)


@dataclass(frozen=True)
class Transformed:
    """``frame`` is lazy over the staged ``distinct`` rows."""

    frame: DataFrame
    raw: DataFrame
    distinct: DataFrame
    cfg: PipelineConfig
    # With earlier batches: the rows before the neighbour fields, the statistics' merged histogram, and the
    # number of rows that earlier batches had stored already.
    replaced: DataFrame | None = None
    histogram: DataFrame | None = None
    stored_before: int = 0


@dataclass(frozen=True)
class Earlier:
    """What the batches before left, see :mod:`loamline.operators.history`; None where there is nothing."""

    tails: DataFrame | None = None
    histograms: DataFrame | None = None
    values: DataFrame | None = None
    keys: DataFrame | None = None


def distinct_readings(raw: DataFrame, spelled: bool = False) -> DataFrame:
    """Normalised readings without full-row copies, compared as they were stored.

    With ``spelled`` the stored spelling of text timestamps stays as a column.
    """
    with_text = keep_spelling(raw)
    kept = tuple(c for c in with_text.columns if c == SPELLING)
    rows = cleaning.dedupe(normalise(with_text.select(*READING_COLUMNS, *kept), keep=kept))
    return rows if spelled else rows.select(*READING_COLUMNS)


def transform(
    raw: DataFrame, cfg: PipelineConfig = PipelineConfig(), earlier: Earlier | None = None
) -> Transformed:
    """clean → time zone → calibrate → outliers → neighbour fields → anomalies.

    The de-duplicated rows are written once; the per-type statistics and the main pass read
    that table, and everything up to the windows is row-wise on top of it.

    With ``earlier`` batches, rows that they have stored are copies, a type's statistics are made of their rows
    too, and the first rows of a series see the last ones before them.
    """
    if earlier is not None:
        return _transform_after(raw, cfg, earlier)
    distinct = stage(distinct_readings(raw), "distinct")
    cleaned = cleaning.clean(distinct, cfg)
    # Replacing values changes no series: sizes and moments are counted at once.
    moments, sizes = together(
        lambda: outliers.type_moments(cleaned), lambda: series.large_series(cleaned, cfg)
    )
    replaced = outliers.replace_outliers(cleaned, moments, cfg)
    enriched = series.series_fields(replaced, cfg, sizes=sizes)
    final = cleaning.flag_anomalies(enriched, cfg)
    columns = [c for c in ENRICHED_COLUMNS if c in final.columns]
    return Transformed(final.select(*columns), raw, distinct, cfg)


def _transform_after(raw: DataFrame, cfg: PipelineConfig, earlier: Earlier) -> Transformed:
    read = stage(distinct_readings(raw, spelled=True), "distinct-read")
    distinct = read if earlier.keys is None else history.without_stored(read, earlier.keys)
    before = 0
    if distinct is not read:
        distinct = stage(distinct, "distinct")
        before = read.count() - distinct.count()  # both from footers
    cleaned = cleaning.clean(distinct.select(*READING_COLUMNS), cfg)
    (moments, merged), sizes = together(
        lambda: history.type_moments(cleaned, earlier.histograms, earlier.values),
        lambda: series.large_series(cleaned, cfg),
    )
    replaced = outliers.replace_outliers(cleaned, moments, cfg)
    enriched = series.series_fields(replaced, cfg, sizes=sizes, history=earlier.tails)
    final = cleaning.flag_anomalies(enriched, cfg)
    columns = [c for c in ENRICHED_COLUMNS if c in final.columns]
    return Transformed(final.select(*columns), raw, distinct, cfg, replaced, merged, before)


def unparsable_time(raw: DataFrame) -> Column:
    """Rows whose stored time is there but is no time; they are dropped with the incomplete ones."""
    if SPELLING in raw.columns:
        return F.col(SPELLING).isNotNull() & F.col("timestamp").isNull()
    stored = F.col("timestamp")
    return stored.isNotNull() & fx.instant_of(stored, raw.schema["timestamp"].dataType).isNull()


def transform_stats(done: Transformed, enriched: DataFrame | None = None) -> DataFrame:
    """One row of counters. Pass the written result as ``enriched`` to read it from there.

    Plain aggregates rather than accumulators, so a re-run task cannot be counted twice.
    """
    frame = done.frame if enriched is None else enriched
    original = done.raw.agg(
        F.count(F.lit(1)).alias("original_records"),
        F.coalesce(F.count_if(unparsable_time(done.raw)), F.lit(0)).alias("unparsable_times"),
    )
    distinct = done.distinct.agg(
        F.count(F.lit(1)).alias("distinct_records"),
        F.count_if(F.col("battery_level").isNull()).alias("missing_values_filled"),
        F.count_if(all_present()).alias("records_after_cleaning"),
        F.lit(done.stored_before).cast("bigint").alias("stored_before"),
    )
    flags = frame.agg(
        F.count(F.lit(1)).alias("records_final"),
        F.count_if("is_outlier").alias("outliers_detected"),
        (F.count_if("anomalous_reading") + F.count_if("battery_anomalous")).alias(
            "anomalous_readings"
        ),
    )
    derived = [c for c in series.ALL_FIELDS if c in frame.columns]
    return one_row(original, distinct, flags).select(
        "original_records",
        "records_after_cleaning",
        F.col("records_after_cleaning").alias("records_after_outlier_removal"),
        "records_final",
        (F.col("original_records") - F.col("distinct_records")).alias("duplicates_removed"),
        *[F.col("stored_before").alias("duplicates_of_earlier_batches")][: done.replaced is not None],
        "unparsable_times",
        "missing_values_filled",
        "outliers_detected",
        "anomalous_readings",
        F.lit("success").alias("status"),
        F.array(*[F.lit(c) for c in derived]).alias("derived_fields_added"),
    )
