"""Reading scans: the five columns, their types, per-file counts, type checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline import functions as fx
from loamline.rows import unit

# The expected columns and their declared types.
READING_TYPES = {
    "sensor_id": "string",
    "timestamp": "timestamp",
    "reading_type": "string",
    "value": "double",
    "battery_level": "double",
}
READING_COLUMNS = tuple(READING_TYPES)
CRITICAL_COLUMNS = ("sensor_id", "timestamp", "reading_type", "value")

# Severity of a column whose data does not fit its declared type at ingest.
CHECK_SEVERITY = {
    "sensor_id": "warning",
    "reading_type": "warning",
    "value": "error",
    "battery_level": "warning",
}


def all_present(columns=CRITICAL_COLUMNS) -> Column:
    """True for rows in which every named column is set."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def stored_present(df: DataFrame) -> Column:
    """:func:`all_present` on stored columns, where a NaN value still stands for "missing"."""
    present = all_present()
    if isinstance(df.schema["value"].dataType, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan("value")
    return present


def scan_readings(spark: SparkSession, *paths: str) -> DataFrame:
    """The five reading columns as stored; other columns are never read."""
    return spark.read.parquet(*paths).select(*READING_COLUMNS)


# The stored spelling of a text timestamp. It takes part in de-duplication only: two spellings
# of one instant are two rows.
SPELLING = "timestamp_text"


def keep_spelling(df: DataFrame) -> DataFrame:
    """Remember text timestamps as stored; other representations have no spelling."""
    if SPELLING in df.columns or not isinstance(df.schema["timestamp"].dataType, T.StringType):
        return df
    return df.withColumn(SPELLING, F.col("timestamp"))


def _number(df: DataFrame, name: str) -> Column:
    # NaN means "missing" in the data model, so it becomes null once, here.
    as_double = F.col(name).try_cast("double")
    return F.when(~F.isnan(as_double), as_double)


def normalise(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bring stored columns to (string, instant, string, double, double)."""
    stamp_type = df.schema["timestamp"].dataType
    return df.select(
        F.col("sensor_id").cast("string").alias("sensor_id"),
        fx.instant_of(F.col("timestamp"), stamp_type).alias("timestamp"),
        F.col("reading_type").cast("string").alias("reading_type"),
        _number(df, "value").alias("value"),
        _number(df, "battery_level").alias("battery_level"),
        *keep,
    )


def union_readings(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column some frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _uncastable(name: str, dtype: T.DataType, expected: str) -> Column | None:
    """Aggregate of values that do not convert; None when the declared type rules them out."""
    if expected == "string" or dtype.simpleString() == expected:
        return None
    if expected == "timestamp":
        converted = fx.instant_of(F.col(name), dtype)
    else:
        converted = F.col(name).cast("string").try_cast(expected)
    return F.count_if(F.col(name).isNotNull() & converted.isNull())


def uncastable_counts(df: DataFrame, columns=READING_COLUMNS) -> DataFrame:
    """(column, expected_type, declared_type, uncastable_count), in one pass.

    Only columns whose declared type leaves room for misfits are read.
    """
    present = [c for c in columns if c in df.columns]
    checks = {c: _uncastable(c, df.schema[c].dataType, READING_TYPES[c]) for c in present}
    doubtful = [agg.alias(c) for c, agg in checks.items() if agg is not None]
    counts = df.agg(*doubtful) if doubtful else unit(df.sparkSession)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(READING_TYPES[c]).alias("expected_type"),
                F.lit(df.schema[c].dataType.simpleString()).alias("declared_type"),
                (F.lit(0).cast("bigint") if checks[c] is None else F.col(c)).alias(
                    "uncastable_count"
                ),
            )
            for c in present
        ]
    )
    return counts.select(F.inline(rows))


def type_check(df: DataFrame) -> DataFrame:
    """Ingest type check: advisory rows (column, expected, severity, uncastable count)."""
    severity = F.create_map(*[F.lit(x) for pair in CHECK_SEVERITY.items() for x in pair])
    return uncastable_counts(df, tuple(CHECK_SEVERITY)).withColumn(
        "severity", severity[F.col("column")]
    )
