"""Small hand-made readings and plain-Python reference computations."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta, timezone

READING_DDL = (
    "sensor_id string, timestamp timestamp, reading_type string, value double, battery_level double"
)
T0 = datetime(2023, 6, 1, 10, tzinfo=timezone.utc)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def readings(spark, rows):
    return spark.createDataFrame(rows, READING_DDL)


def skewed_rows(seed: int = 7, n: int = 900):
    """A third of all rows in one series, many instants shared within it."""
    rng = random.Random(seed)
    rows = set()
    while len(rows) < n:
        hot = rng.random() < 0.4
        sensor = "hot" if hot else f"s{rng.randrange(6)}"
        kind = "temperature" if hot else rng.choice(["temperature", "humidity"])
        minute = rng.randrange(0, 14 * 24 * 60, 30 if hot else 7)
        value = round(rng.gauss(20, 8), 2)
        rows.add((sensor, at(minute), kind, value, float(rng.randrange(100))))
    return sorted(rows, key=repr)


def close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)
