"""What a batch leaves behind for the batches after it, and how they use it.

Day batches are the way to run a large table, but a series does not begin anew each day. Every kind of
history below is small beside the rows, merges with that of other batches, and is read by its columns alone:

* ``tails``: the last rows of every series so far, for row frames, lags and differences;
* ``histograms`` and ``values``: mergeable moments per type on logarithmic bins, and the counted values
  of each bin, so that the exact median over all batches reads one bin of the older ones;
* ``keys``: the rows of a batch as they were read, so that a copy in a later file is found;
* ``hour_sums``: sums per series and hour, for means over day spans;
* ``day_sums``: sums per series and local day, for days that lie in two batches;
* ``hour_bits``: one 24-bit map per series and day, for coverage and gaps without the rows.

The choice of history is: a batch knows all published batches whose windows end before its own begins, and
itself. Loading the batches in order, some of them again, gives the same rows as deciding every day with
all rows up to that day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamline import functions as fx
from loamline.config import PipelineConfig
from loamline.operators import quality
from loamline.operators.profiles import histogram, log_bin, medians_of, merge_histograms, moments_of
from loamline.operators.series import SERIES, total_order
from loamline.sources.readings import READING_COLUMNS, SPELLING, all_present
from loamline.staging import stage

_SERIES_DDL = "sensor_id string, reading_type string"
SCHEMAS = {
    "tails": f"{_SERIES_DDL}, timestamp timestamp, source_value double, battery_level double, value double",
    "histograms": "reading_type string, bin int, c bigint, lo double, hi double, mean double, m2 double",
    "values": "reading_type string, bin int, v double, c bigint",
    "keys": "sensor_id string, timestamp timestamp, reading_type string, value double, battery_level double, "
    f"{SPELLING} string",
    "hour_sums": f"{_SERIES_DDL}, span_hour bigint, s double, c bigint, rows bigint",
    "day_sums": f"{_SERIES_DDL}, date string, s double, c bigint",
    "hour_bits": f"{_SERIES_DDL}, day_no bigint, bits int, readings bigint, first timestamp_ntz, last timestamp_ntz",
}

# --- neighbours ----------------------------------------------------------------------


def tails(rows: DataFrame, older: DataFrame | None, cfg: PipelineConfig) -> DataFrame:
    """The last rows of each series, those of earlier batches included.

    ``rows`` have ``source_value`` and the final ``value``. The rank limit is applied before the shuffle, so
    a series that holds a third of the rows moves a few rows per task.
    """
    columns = [*SERIES, "timestamp", "source_value", "battery_level", "value"]
    both = rows.select(*columns)
    if older is not None:
        both = both.unionByName(older.select(*columns))
    last_first = W.partitionBy(*SERIES).orderBy(*[F.desc_nulls_last(c) for c in total_order(both)])
    ranked = both.withColumn("_rank", F.row_number().over(last_first))
    return ranked.where(F.col("_rank") <= max(cfg.rolling_rows - 1, 1)).drop("_rank")


# --- copies --------------------------------------------------------------------------


def keys(distinct: DataFrame) -> DataFrame:
    """The rows that a batch stores, as they were read."""
    spelled = distinct if SPELLING in distinct.columns else distinct.withColumn(SPELLING, F.lit(None).cast("string"))
    return spelled.where(all_present()).select(*READING_COLUMNS, SPELLING)


def without_stored(distinct: DataFrame, stored: DataFrame) -> DataFrame:
    """``distinct`` without the rows that earlier batches have stored.

    Two rows are copies if all their columns, nulls and the spelling of the time included, are equal. Only stored
    rows between the batch's first and last instant can match: the files keep them by time, so the bounds
    leave the few rows at the border, and their measured size decides the join.
    """
    bounds = distinct.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).first()
    if bounds.low is None:
        return distinct
    low, high = F.lit(bounds.low), F.lit(bounds.high)
    near = stage(stored.where((F.col("timestamp") >= low) & (F.col("timestamp") <= high)), "stored-near")
    both = [*READING_COLUMNS, *([SPELLING] if SPELLING in distinct.columns else [])]
    named = near.select(*[F.col(c).alias(f"_{c}") for c in both])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in both]
    if SPELLING not in distinct.columns:
        named = near.where(F.col(SPELLING).isNull()).select(*[F.col(c).alias(f"_{c}") for c in both])
    return distinct.join(named, same, "left_anti")


# --- statistics of a type ---------------------------------------------------------------


def value_counts(df: DataFrame) -> DataFrame:
    """(reading_type, bin, v, c): how often each value occurs, by bin."""
    v = F.col("value")
    counted = df.where(v.isNotNull()).groupBy("reading_type", log_bin(v).alias("bin"), v.alias("v"))
    return counted.agg(F.count(F.lit(1)).alias("c"))


# With more types than this the bins of the medians are not spelled out for the reader of older values.
_SPELLED_TYPES = 1_000


def type_moments(
    df: DataFrame, older: DataFrame | None = None, values: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(moments, merged histogram) of the values of ``df`` and of all batches before.

    ``older`` is their merged histogram, ``values`` their counted values, of which only the bins that hold a
    median are read. The median is exact over all rows.
    """
    own = histogram(df, "reading_type", "value")
    if older is None:
        merged = stage(own, "histogram")
        return _moments(merged, medians_of(df, "reading_type", "value", merged)), merged
    merged = stage(merge_histograms(own, older.select(*own.columns), "reading_type"), "histogram")
    middle = stage(_median_bins(merged), "median-bins")
    wanted = values.join(middle, ["reading_type", "bin"], "left_semi")
    few = middle.limit(2 * _SPELLED_TYPES + 1).collect()
    if few and len(few) <= 2 * _SPELLED_TYPES:
        # Spelled out, so that the files' statistics leave the other bins unread.
        bins = sorted({r.bin for r in few})
        wanted = values.where(F.col("bin").isin(*bins)).join(middle, ["reading_type", "bin"], "left_semi")
    own_values = df.select("reading_type", "value", F.lit(1).cast("bigint").alias("_times"))
    counted = own_values.unionByName(wanted.select("reading_type", F.col("v").alias("value"), F.col("c").alias("_times")))
    return _moments(merged, medians_of(counted, "reading_type", "value", merged, times="_times")), merged


def _moments(merged: DataFrame, medians: DataFrame) -> DataFrame:
    joined = moments_of(merged, "reading_type").join(medians, "reading_type", "left").select(
        "reading_type", "n", "mean", F.sqrt(F.col("m2") / F.col("n")).alias("std"), "median"
    )
    return stage(joined, "type-moments")


def _median_bins(merged: DataFrame) -> DataFrame:
    """(reading_type, bin): the bins that hold a middle value."""
    by_bin = W.partitionBy("reading_type").orderBy("bin")
    upto = F.sum("c").over(by_bin)
    n = F.sum("c").over(W.partitionBy("reading_type"))
    low, high = F.call_function("div", n - 1, F.lit(2)), F.call_function("div", n, F.lit(2))
    placed = merged.select("reading_type", "bin", (upto - F.col("c")).alias("a"), upto.alias("z"), low.alias("lo_"), high.alias("hi_"))
    return placed.where((F.col("a") <= F.col("hi_")) & (F.col("lo_") < F.col("z"))).select("reading_type", "bin")


# --- sums ------------------------------------------------------------------------------

_MICROS_PER_HOUR = 3_600_000_000


def utc_hour(instant: Column) -> Column:
    us = F.unix_micros(instant)
    return F.call_function("div", us - F.pmod(us, F.lit(_MICROS_PER_HOUR)), F.lit(_MICROS_PER_HOUR))


def hour_sums(df: DataFrame) -> DataFrame:
    """(sensor, type, span_hour, s, c, rows) of the final values."""
    return df.groupBy(*SERIES, utc_hour(F.col("timestamp")).alias("span_hour")).agg(
        F.sum("value").alias("s"), F.count("value").alias("c"), F.count(F.lit(1)).alias("rows")
    )


def day_sums(df: DataFrame) -> DataFrame:
    """(sensor, type, date, s, c) of the final values."""
    return df.groupBy(*SERIES, "date").agg(F.sum("value").alias("s"), F.count("value").alias("c"))


def with_whole_days(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """``rows`` of a table with day means over all batches that share the day.

    A local day lies in two batches of UTC days; the earlier one cannot know the later one's rows, so the mean
    is made of both batches' sums when the table is read. ``sums`` are the :func:`day_sums` with ``batch``.
    """
    split = sums.groupBy(*SERIES, "date").agg(
        F.count(F.lit(1)).alias("_parts"), F.sum("s").alias("_s"), F.sum("c").alias("_c")
    )
    means = split.where("_parts > 1").select(*SERIES, "date", F.try_divide("_s", "_c").alias("_mean"), F.lit(True).alias("_split"))
    joined = rows.join(means, [*SERIES, "date"], "left")
    mean = F.when(F.col("_split"), F.col("_mean")).otherwise(F.col("daily_avg_value"))
    return joined.withColumn("daily_avg_value", mean).select(*rows.columns)


# --- hours with readings ------------------------------------------------------------------


def hour_bits(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """(sensor, type, day_no, bits, readings, first, last): the hours of a local day as a 24-bit map."""
    hours = quality.active_hours(df, cfg).where(F.col("hour_no").isNotNull())
    bit = F.call_function("shiftleft", F.lit(1), F.pmod(F.col("hour_no"), F.lit(24)).cast("int"))
    return hours.groupBy(*SERIES, fx.day_of_hour(F.col("hour_no")).alias("day_no")).agg(
        F.bit_or(bit).alias("bits"),
        F.sum("readings").alias("readings"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


def merged_bits(days: DataFrame) -> DataFrame:
    """One row per series and day out of the maps of several batches."""
    return days.groupBy(*SERIES, "day_no").agg(
        F.bit_or("bits").alias("bits"),
        F.sum("readings").alias("readings"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


def calendar_of(days: DataFrame) -> DataFrame:
    """The :func:`quality.series_calendar` of merged maps, by counting bits."""
    return days.groupBy(*SERIES).agg(
        F.sum("readings").alias("reading_count"),
        F.min("first").alias("first_reading"),
        F.max("last").alias("last_reading"),
        F.count("day_no").alias("days_with_data"),
        (F.min("day_no") * 24).alias("first_hour"),
        (F.max("day_no") * 24 + 23).alias("last_hour"),
        F.sum(F.bit_count("bits").cast("bigint")).alias("active"),
    )


def hours_of(days: DataFrame) -> DataFrame:
    """(sensor, type, hour_no) of the set bits; a day gives at most 24 rows."""
    set_bits = F.filter(
        F.sequence(F.lit(0), F.lit(23)), lambda h: F.call_function("getbit", F.col("bits"), h) == 1
    )
    return days.select(*SERIES, "day_no", F.explode(set_bits).alias("_h")).select(
        *SERIES, (F.col("day_no") * 24 + F.col("_h")).alias("hour_no")
    )


