"""Scalar helpers; every one builds a Column from built-in expressions."""

from loamline.functions.scalars import (
    format_duration,
    map_merge,
    megabytes,
    next_run,
    percent,
    percent_text,
    run_duration,
    safe_divide,
    schedule_class,
    z_score,
)
from loamline.functions.times import (
    day_of_hour,
    hour_index,
    hour_start,
    instant_of,
    iso_in_zone,
    parse_instant,
    wall_time,
)

__all__ = [
    "day_of_hour",
    "format_duration",
    "hour_index",
    "hour_start",
    "instant_of",
    "iso_in_zone",
    "map_merge",
    "megabytes",
    "next_run",
    "parse_instant",
    "percent",
    "percent_text",
    "run_duration",
    "safe_divide",
    "schedule_class",
    "wall_time",
    "z_score",
]
