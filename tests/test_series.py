"""Window fields: values, edge cases, and equality of the plain and the sliced way."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from loamline.config import PipelineConfig
from loamline.operators import cleaning, series
from tests.helpers import at, close, readings, skewed_rows

CFG = PipelineConfig()
FIELDS = series.ALL_FIELDS


def keyed(df, fields):
    return {
        (r.sensor_id, r.reading_type, r.timestamp, r.value, r.battery_level): tuple(
            r[f] for f in fields
        )
        for r in df.collect()
    }


def same(left, right):
    assert left.keys() == right.keys()
    for k in left:
        assert all(close(a, b) for a, b in zip(left[k], right[k])), (k, left[k], right[k])


def test_values_of_a_short_series(spark):
    rows = [("s", at(m), "temperature", v, 90.0) for m, v in ((0, 1.0), (30, 2.0), (90, 6.0))]
    df = cleaning.local_fields(readings(spark, rows), CFG)
    out = sorted(series.series_fields(df, CFG).collect(), key=lambda r: r.timestamp)
    assert [r.rolling_7day_avg for r in out] == [None, 1.5, 3.0]
    assert [r.value_change for r in out] == [None, 1.0, 4.0]
    assert [r.time_diff_hours for r in out] == [None, 0.5, 1.0]
    assert [r.daily_avg_value for r in out] == [3.0] * 3


def test_single_row_group(spark):
    df = cleaning.local_fields(readings(spark, [("s", at(0), "t", 5.0, 1.0)]), CFG)
    (r,) = series.series_fields(df, CFG).collect()
    assert (r.daily_avg_value, r.rolling_7day_avg, r.value_change) == (5.0, None, None)


def test_rolling_uses_seven_rows(spark):
    rows = [("s", at(m), "t", float(m), 1.0) for m in range(10)]
    df = cleaning.local_fields(readings(spark, rows), CFG)
    out = {r.value: r.rolling_7day_avg for r in series.series_fields(df, CFG).collect()}
    assert out[9.0] == sum(range(3, 10)) / 7


@pytest.mark.parametrize("limit,slice_rows", [(0, 40), (100, 25), (100, 3), (0, 1)])
def test_sliced_equals_plain(spark, limit, slice_rows):
    df = cleaning.local_fields(readings(spark, skewed_rows()), CFG)
    plain = keyed(series.series_fields(df, CFG), FIELDS)
    cut = CFG.with_(max_series_rows=limit, rows_per_slice=slice_rows)
    same(plain, keyed(series.series_fields(df, cut), FIELDS))


def brute_rolling_days(rows, days=7):
    out = {}
    for row in rows:
        low = row[1] - timedelta(days=days)
        seen = [
            r[3] for r in rows if r[0] == row[0] and r[2] == row[2] and low < r[1] <= row[1]
        ]
        out[row] = sum(seen) / len(seen) if len(seen) >= 2 else None
    return out


@pytest.mark.parametrize("limit,slice_rows", [(10**9, 10), (3, 7), (0, 50), (0, 2)])
def test_rolling_days_equals_brute_force(spark, limit, slice_rows):
    rows = skewed_rows(seed=11, n=500)
    cut = CFG.with_(max_series_rows=limit, rows_per_slice=slice_rows)
    out = series.rolling_days(readings(spark, rows), cut)
    # Compare on epoch seconds: collected timestamps are naive local times.
    got = {
        (r.sensor_id, r.s, r.reading_type, r.value, r.battery_level): r.rolling_days_avg
        for r in out.withColumn("s", F.unix_micros("timestamp")).collect()
    }
    want = {
        (k[0], int(k[1].timestamp()) * 10**6, k[2], k[3], k[4]): v
        for k, v in brute_rolling_days(rows).items()
    }
    assert got.keys() == want.keys()
    for k in want:
        assert close(got[k], want[k]), (k, got[k], want[k])


def test_rolling_days_bounds(spark):
    day = 24 * 60
    # Exactly seven days old is outside the span, a moment younger is inside.
    rows = [("s", at(0), "t", 10.0, 1.0), ("s", at(1), "t", 20.0, 1.0), ("s", at(7 * day), "t", 30.0, 1.0)]
    out = series.rolling_days(readings(spark, rows), CFG)
    assert {r.value: r.rolling_days_avg for r in out.collect()} == {10.0: None, 20.0: 15.0, 30.0: 25.0}


def test_one_instant_mass_is_sliceable(spark):
    rows = [("hot", at(0), "t", float(i), 1.0) for i in range(300)] + [
        ("hot", at(60 * 24), "t", 1000.0, 1.0)
    ]
    cut = CFG.with_(max_series_rows=20, rows_per_slice=10)
    out = series.rolling_days(readings(spark, rows), cut)
    means = {r.value: r.rolling_days_avg for r in out.collect()}
    assert close(means[0.0], 149.5) and close(means[1000.0], (149.5 * 300 + 1000) / 301)
