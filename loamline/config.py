"""Settings and dimension data of the readings pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.rows import local_frame


@dataclass(frozen=True)
class Calibration:
    multiplier: float = 1.0
    offset: float = 0.0
    unit: str = ""


@dataclass(frozen=True)
class ValueRange:
    low: float
    high: float
    unit: str = ""


# The known reading types with their unit and expected range.
# Every shipped calibration is the identity.
_RANGES = {
    "temperature": ValueRange(-10.0, 60.0, "°C"),
    "humidity": ValueRange(0.0, 100.0, "%"),
    "soil_moisture": ValueRange(0.0, 100.0, "%"),
    "light_intensity": ValueRange(0.0, 100000.0, "lux"),
    "air_pressure": ValueRange(800.0, 1200.0, "hPa"),
    "wind_speed": ValueRange(0.0, 50.0, "m/s"),
    "rainfall": ValueRange(0.0, 500.0, "mm"),
}
BATTERY_RANGE = ValueRange(0.0, 100.0, "%")
FALLBACK_RANGE = ValueRange(0.0, 100.0)


def _default_calibrations() -> dict[str, Calibration]:
    return {name: Calibration(unit=r.unit) for name, r in _RANGES.items()}


@dataclass(frozen=True)
class PipelineConfig:
    """One immutable bundle of everything a run can be told."""

    target_timezone: str = "Asia/Kolkata"
    z_score_threshold: float = 3.0
    min_rows_for_outliers: int = 10  # a type needs MORE rows than this
    missing_value_threshold: float = 0.1
    default_battery: float = 100.0
    rolling_rows: int = 7
    rolling_days: int = 7
    rolling_min_rows: int = 2
    # One folder per day; files are sorted by sensor. A key per sensor makes a folder per sensor and day.
    partition_by: tuple[str, ...] = ("date",)
    compression: str = "snappy"
    calibrations: dict[str, Calibration] = field(default_factory=_default_calibrations)
    ranges: dict[str, ValueRange] = field(default_factory=lambda: dict(_RANGES))
    battery_range: ValueRange = BATTERY_RANGE
    fallback_range: ValueRange = FALLBACK_RANGE

    # Scale knobs. A (sensor, type) series above ``max_series_rows`` is cut
    # into slices of about ``rows_per_slice`` rows before any window runs.
    max_series_rows: int = 5_000_000
    rows_per_slice: int = 1_000_000

    def with_(self, **changes) -> "PipelineConfig":
        return replace(self, **changes)

    @property
    def calibrates(self) -> bool:
        """True when some type has a calibration other than the identity."""
        return any(c.multiplier != 1.0 or c.offset != 0.0 for c in self.calibrations.values())


def calibration_dim(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """(reading_type, multiplier, offset, unit) — one row per configured type."""
    rows = [(t, c.multiplier, c.offset, c.unit) for t, c in sorted(cfg.calibrations.items())]
    return local_frame(
        spark, rows, "reading_type string, multiplier double, offset double, unit string"
    )


def range_dim(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """(reading_type, expected_min, expected_max, unit), with the battery row."""
    entries = dict(cfg.ranges)
    entries.setdefault("battery_level", cfg.battery_range)
    rows = [(t, r.low, r.high, r.unit) for t, r in sorted(entries.items())]
    return local_frame(
        spark, rows, "reading_type string, expected_min double, expected_max double, unit string"
    )


# A config larger than this is not a dimension any more and is joined unhinted.
MAX_BROADCAST_DIM_ROWS = 100_000


def with_calibration(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Attach ``multiplier`` and ``offset`` of each row's type (identity if unknown)."""
    dim = calibration_dim(df.sparkSession, cfg).drop("unit")
    if len(cfg.calibrations) <= MAX_BROADCAST_DIM_ROWS:
        dim = F.broadcast(dim)
    return (
        df.join(dim, "reading_type", "left")
        .withColumn("multiplier", F.coalesce("multiplier", F.lit(1.0)))
        .withColumn("offset", F.coalesce("offset", F.lit(0.0)))
    )


def with_range(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Attach ``expected_min`` and ``expected_max`` (fallback range if unknown)."""
    dim = range_dim(df.sparkSession, cfg).drop("unit")
    if len(cfg.ranges) <= MAX_BROADCAST_DIM_ROWS:
        dim = F.broadcast(dim)
    return (
        df.join(dim, "reading_type", "left")
        .withColumn("expected_min", F.coalesce("expected_min", F.lit(cfg.fallback_range.low)))
        .withColumn("expected_max", F.coalesce("expected_max", F.lit(cfg.fallback_range.high)))
    )
