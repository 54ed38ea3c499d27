"""Arithmetic, text and map helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The schedule names that are intervals rather than cron text.
INTERVAL_SCHEDULES = ("daily", "hourly", "weekly")


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Quotient, or ``default`` for a zero divisor or a null operand."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(default))


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; 0 for an empty whole."""
    return safe_divide(part * F.lit(100.0), whole)


def percent_text(value: Column) -> Column:
    """Two decimals, ties to even, and a percent sign."""
    return F.format_string("%.2f%%", F.bround(value, 2))


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in standard deviations; 0 for constant data."""
    return F.when(std == 0, F.lit(0.0)).otherwise(F.abs((value - mean) / std))


def format_duration(seconds: Column) -> Column:
    """Seconds as ``x.xs``, ``x.xm`` or ``x.xh``; one decimal, ties to even."""
    shown = lambda pattern, x: F.format_string(pattern, F.bround(x, 1))
    return (
        F.when(seconds < 60, shown("%.1fs", seconds))
        .when(seconds < 3600, shown("%.1fm", seconds / 60))
        .otherwise(shown("%.1fh", seconds / 3600))
    )


def megabytes(size_in_bytes: Column) -> Column:
    return size_in_bytes / F.lit(1024.0 * 1024.0)


def run_duration(start: Column, end: Column) -> Column:
    """Seconds between two times; null unless both are known."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def schedule_class(schedule: Column) -> Column:
    """``struct(schedule, class)``: interval names lower-cased, the rest as given."""
    known = F.lower(schedule).isin(*INTERVAL_SCHEDULES)
    return F.struct(
        F.when(known, F.lower(schedule)).otherwise(schedule).alias("schedule"),
        F.when(known, F.lit("predefined")).otherwise(F.lit("other")).alias("class"),
    )


def next_run(schedule: Column, as_of: Column) -> Column:
    """Next start of an interval schedule after ``as_of`` (a wall time); else null."""
    hours = lambda n: F.make_dt_interval(hours=F.lit(n))
    days = lambda n: F.make_dt_interval(days=n)
    midnight = F.date_trunc("day", as_of).cast("timestamp_ntz")
    two_am = midnight + hours(2)
    # weekday(): Monday is 0, so a Monday is a full week ahead.
    to_monday = F.lit(7) - F.weekday(as_of)
    name = F.lower(schedule)
    return (
        F.when(name == "daily", F.when(two_am <= as_of, two_am + hours(24)).otherwise(two_am))
        .when(name == "hourly", F.date_trunc("hour", as_of).cast("timestamp_ntz") + hours(1))
        .when(name == "weekly", midnight + days(to_monday) + hours(2))
    )


def map_merge(base: Column, overrides: Column) -> Column:
    """Shallow merge of two maps; a key present on the right wins, null included."""
    return F.map_zip_with(
        base,
        overrides,
        lambda key, left, right: F.when(F.map_contains_key(overrides, key), right).otherwise(left),
    )
