"""Quality sections on hand-made frames."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from loamline.config import Calibration, PipelineConfig, ValueRange
from loamline.operators import cleaning, quality
from loamline.plans.transform import transform, transform_stats
from loamline.sinks.reports import report_sections
from tests.helpers import at, close, readings

CFG = PipelineConfig()


def rows_of(df, key):
    return {r[key]: r for r in df.collect()}


def test_bounds_are_normal_and_unknown_types_use_the_fallback(spark):
    data = [
        ("s", at(0), "temperature", -10.0, 0.0),
        ("s", at(1), "temperature", 60.0, 100.0),
        ("s", at(2), "temperature", 60.01, 100.01),
        ("s", at(3), "mystery", 100.0, -0.01),
        ("s", at(4), "mystery", 100.5, 50.0),
        ("s", at(5), "it's quoted", -1.0, 50.0),
    ]
    out = {r.timestamp.minute: r for r in cleaning.flag_anomalies(readings(spark, data), CFG).collect()}
    assert [out[i].anomalous_reading for i in range(6)] == [False, False, True, False, True, True]
    assert [out[i].battery_anomalous for i in range(6)] == [False, False, True, True, False, False]


def test_calibration(spark):
    cfg = CFG.with_(calibrations={"humidity": Calibration(1.02, -1.0)})
    df = readings(spark, [("s", at(0), "humidity", 50.0, 1.0), ("s", at(1), "temperature", 20.0, 1.0)])
    out = rows_of(cleaning.calibrate(df, cfg), "reading_type")
    assert close(out["humidity"].value, 50.0) and close(out["humidity"].calibrated_value, 50.0)
    assert out["temperature"].value == 20.0 and out["temperature"].calibrated_value is None
    assert "calibrated_value" not in cleaning.calibrate(df, CFG).columns


def test_missing_values(spark):
    df = spark.createDataFrame([(None, 1), (2, 1), (3, None), (4, 1)] * 5, "a int, b int")
    out = rows_of(quality.missing_values(df, CFG.with_(missing_value_threshold=0.25)), "column")
    assert out["a"].missing_percentage == 25.0 and out["a"].is_acceptable
    assert not rows_of(quality.missing_values(df, CFG), "column")["a"].is_acceptable
    assert set(rows_of(quality.missing_values(df, CFG, ["b"]), "column")) == {"b"}


def test_null_values_count_as_out_of_range(spark):
    df = readings(spark, [("s", at(0), "t", 5.0, 1.0), ("s", at(1), "t", None, 1.0)])
    r = rows_of(quality.value_ranges(quality.type_summary(df, CFG)), "reading_type")["t"]
    assert (r.total_count, r.valid_count, r.out_of_range_count, r.valid_percentage) == (2, 1, 1, 50.0)


def test_coverage_can_exceed_one_hundred(spark):
    # 23:00 to 01:00 local: two calendar days, less than one elapsed day.
    data = [("s", at(450), "t", 1.0, 1.0), ("s", at(570), "t", 1.0, 1.0)]
    hours = quality.active_hours(readings(spark, data), CFG)
    (r,) = quality.time_coverage(quality.series_calendar(hours)).collect()
    assert (r.days_with_data, r.time_span_days, r.coverage_percentage) == (2, 1, 200.0)
    assert r.first_reading.hour == 23 and r.last_reading.hour == 1


def test_gaps(spark):
    # Local hours 15 and 17 of one day.
    data = [("s", at(0), "t", 1.0, 1.0), ("s", at(5), "t", 1.0, 1.0), ("s", at(120), "t", 1.0, 1.0)]
    hours = quality.active_hours(readings(spark, data), CFG)
    (r,) = quality.gap_report(hours).collect()
    missing = [h for h in range(24) if h not in (15, 17)]
    assert r.missing_hours_count == 22 and [x.hour for x in r.missing_hours] == missing
    assert str(r.start_date) == str(r.end_date) == "2023-06-01"
    assert quality.gap_hours(hours).count() == quality.missing_by_anti_join(hours).count() == 22


def test_spans_of_a_stray_time_hold_no_long_array(spark):
    data = [("s", at(0), "t", 1.0, 1.0), ("s", datetime(1970, 1, 1, 0, 30, tzinfo=timezone.utc), "t", 1.0, 1.0)]
    hours = quality.active_hours(readings(spark, data), CFG)
    spans = quality.gap_span_report(hours).collect()
    counted = quality.gap_counts(quality.series_calendar(hours)).first().missing_hours_count
    assert len(spans) == 3 and sum(s.missing_hours_count for s in spans) == counted > 460_000
    each = quality.gap_hours(hours).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("missing_hour").alias("d")).first()
    assert each.n == each.d == counted
    sections = {r.section for r in report_sections(quality.validate(cleaning.flag_anomalies(readings(spark, data), CFG), CFG)).collect()}
    assert "data_gap_spans" in sections


def test_full_day_has_no_gap(spark):
    local_midnight = -15 * 60 - 30
    data = [("s", at(local_midnight + 60 * h), "t", 1.0, 1.0) for h in range(24)]
    (r,) = quality.gap_report(quality.active_hours(readings(spark, data), CFG)).collect()
    assert r.missing_hours == [] and r.missing_hours_count == 0


def test_score(spark):
    local_midnight = -15 * 60 - 30
    data = [("s", at(local_midnight + 60 * h), "temperature", 20.0, 50.0) for h in range(24)]
    df = cleaning.flag_anomalies(readings(spark, data), CFG)
    assert quality.validate(df, CFG).score.first()[0] == 100.0
    # Half of the values out of range: 25 for the range, 15 for the anomalies.
    bad = [(s, t, k, 99.0 if i % 2 else v, b) for i, (s, t, k, v, b) in enumerate(data)]
    q = quality.validate(cleaning.flag_anomalies(readings(spark, bad), CFG), CFG)
    assert q.score.first()[0] == 60.0
    assert {r.section for r in q.deductions.collect()} == {"value_ranges", "anomalies"}


def test_gap_deduction_is_capped(spark):
    days = 12 * 24 * 60
    data = [("s", at(0), "t", 1.0, 1.0), ("s", at(days), "t", 1.0, 1.0)]
    q = quality.validate(cleaning.flag_anomalies(readings(spark, data), CFG), CFG)
    assert {r.deduction for r in q.deductions.collect()} == {20.0}


def test_empty_frame_is_an_error(spark):
    with pytest.raises(ValueError):
        quality.validate(readings(spark, []), CFG)


def test_all_null_column(spark):
    df = readings(spark, [("s", at(i), "t", None, None) for i in range(3)])
    q = quality.validate(df, CFG)
    out = rows_of(q.missing, "column")
    assert out["value"].missing_count == 3 and not out["value"].is_acceptable
    assert rows_of(q.ranges, "reading_type")["t"].actual_avg is None


def test_type_validity(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "sensor_id int, value string, other double")
    out = rows_of(quality.type_validity(df), "column")
    assert not out["sensor_id"].is_valid and not out["value"].is_valid and out["other"].is_valid
    assert out["value"].uncastable_count == 1


def test_report(spark):
    data = [("s", at(0), "temperature", 20.0, 50.0), ("s", at(60), "temperature", 99.0, 50.0)]
    q = quality.validate(cleaning.flag_anomalies(readings(spark, data), CFG), CFG)
    rows = {r.metric: (r.value, r.category) for r in quality.report_rows(q).collect()}
    assert rows["Valid Range - temperature"] == ("50.00%", "Data Accuracy")
    assert rows["Total Records"] == ("2", "Overall")
    assert rows["Total Missing Hours"] == ("22", "Data Continuity")
    sections = {r.section for r in report_sections(q).collect()}
    assert "data_gaps" in sections and "time_coverage" in sections


# --- the whole transform -----------------------------------------------------------


def test_transform_counters(spark):
    data = [("s", at(i), "temperature", 20.0 + i % 3, 90.0) for i in range(30)]
    data += [data[0], data[0]]  # two copies
    data += [("s", at(40), "temperature", 21.0, None)]  # filled
    data += [("s", at(41), "temperature", None, None)]  # filled, then dropped
    data += [(None, at(42), "temperature", 1.0, 5.0)]  # dropped
    data += [("s", at(43), "temperature", 5000.0, 120.0)]  # outlier, odd battery
    done = transform(readings(spark, data), CFG)
    (s,) = transform_stats(done).collect()
    assert (s.original_records, s.duplicates_removed, s.missing_values_filled) == (36, 2, 2)
    assert (s.records_after_cleaning, s.records_final, s.outliers_detected) == (32, 32, 1)
    # The outlier was replaced before the range check, so only its battery is anomalous.
    assert s.anomalous_readings == 1
    assert done.frame.where("is_outlier").first().value == 21.0
    assert len(s.derived_fields_added) == 4


def test_copies_are_compared_as_stored(spark):
    rows = [("s", "2023-06-01T10:00:00Z", "t", 1.0, 1.0)] * 2 + [("s", "2023-06-01T10:00:00", "t", 1.0, 1.0)]
    raw = spark.createDataFrame(
        rows, "sensor_id string, timestamp string, reading_type string, value double, battery_level double"
    )
    (s,) = transform_stats(transform(raw, CFG)).collect()
    assert (s.original_records, s.duplicates_removed, s.records_final) == (3, 1, 2)


def test_transform_columns_and_empty_input(spark):
    done = transform(readings(spark, []), CFG)
    assert done.frame.count() == 0
    assert done.frame.columns == [
        "sensor_id", "timestamp", "reading_type", "value", "battery_level", "date", "hour",
        "is_outlier", "daily_avg_value", "rolling_7day_avg", "value_change", "time_diff_hours",
        "anomalous_reading", "battery_anomalous",
    ]


def test_transform_with_forced_slicing_is_the_same(spark):
    from tests.helpers import skewed_rows

    df = readings(spark, skewed_rows(n=400))
    cfg = CFG.with_(ranges={"temperature": ValueRange(5.0, 30.0)})
    pick = lambda c: sorted(
        (tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in transform(df, c).frame.collect())
    )
    assert pick(cfg) == pick(cfg.with_(max_series_rows=50, rows_per_slice=20))


def test_sections_do_not_shuffle_rows(spark):
    """The per-type section must aggregate before its exchange."""
    df = cleaning.flag_anomalies(readings(spark, [("s", at(0), "t", 1.0, 1.0)]), CFG)
    plan = quality.type_summary(df, CFG)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "partial_count" in plan
