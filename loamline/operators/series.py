"""Fields that depend on the neighbours of a reading in its (sensor, type) series.

Series of ordinary size go through plain window functions: one exchange on (sensor, type)
serves the day means, the trailing means and the differences.

A series above ``cfg.max_series_rows`` would put all its rows into one window task. Those
series are cut into slices by a range partitioning on their total order, and what crosses a
cut is passed on as a few extra rows:

* the last rows before a slice are prepended to it ("carry" rows), so row frames and lags see
  them, and are dropped afterwards;
* a day that crosses a cut gets its mean from per-slice sums.

Both are bounded by the number of slices, and the result equals the plain one.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from loamline.config import PipelineConfig
from loamline.staging import stage

SERIES = ["sensor_id", "reading_type"]
ALL_FIELDS = ("daily_avg_value", "rolling_7day_avg", "value_change", "time_diff_hours")
_MICROS_PER_HOUR = 3_600_000_000


def total_order(df: DataFrame, tiebreak: str | None = None) -> list[str]:
    """Columns that order a series totally once full-row copies are gone."""
    source = "source_value" if "source_value" in df.columns else "value"
    return ["timestamp", source, "battery_level"] + ([tiebreak] if tiebreak else [])


def _sequence_fields(within: WindowSpec, cfg: PipelineConfig) -> dict[str, Column]:
    trailing = within.rowsBetween(-(cfg.rolling_rows - 1), 0)
    enough = F.count("value").over(trailing) >= cfg.rolling_min_rows
    previous = F.lag("timestamp").over(within)
    return {
        "rolling_7day_avg": F.when(enough, F.avg("value").over(trailing)),
        "value_change": F.col("value") - F.lag("value").over(within),
        "time_diff_hours": F.timestamp_diff("MICROSECOND", previous, F.col("timestamp"))
        / F.lit(3.6e9),
    }


# Marks rows of earlier batches, which later rows see and which are no rows of the result.
HISTORIC = "historic"


def _own_value(df: DataFrame) -> Column:
    return F.when(~F.col(HISTORIC), F.col("value")) if HISTORIC in df.columns else F.col("value")


def _pick(fields: dict[str, Column], wanted: tuple[str, ...]) -> dict[str, Column]:
    return {name: col for name, col in fields.items() if name in wanted}


def _plain(df: DataFrame, cfg: PipelineConfig, wanted: tuple[str, ...], order: list[str]):
    fields = _sequence_fields(W.partitionBy(*SERIES).orderBy(*order), cfg)
    if "daily_avg_value" in wanted:
        # (sensor, type) partitioning already co-locates each (sensor, type, date).
        fields["daily_avg_value"] = F.avg(_own_value(df)).over(W.partitionBy(*SERIES, "date"))
    return df.withColumns(_pick(fields, wanted))


# --- slicing ----------------------------------------------------------------


def cut_into_slices(df: DataFrame, order: list[str], slices: int) -> DataFrame:
    """``df`` with a ``slice`` number: contiguous, balanced runs of the given order.

    Written out, because the cut points come from sampling: every later read must see the
    same ones.
    """
    ranged = df.repartitionByRange(max(1, slices), *order)
    return stage(ranged.withColumn("slice", F.spark_partition_id()), "slices")


def _carry_rows(sliced: DataFrame, order: list[str], count: int) -> DataFrame:
    """For each slice of a series, the ``count`` rows right before it, tagged with it."""
    last_first = W.partitionBy(*SERIES, "slice").orderBy(*[F.desc_nulls_last(c) for c in order])
    payload = list(dict.fromkeys([*order, "value"]))
    # The rank limit is applied before the shuffle, so only a few rows per slice move.
    tails = (
        sliced.select(*SERIES, "slice", *payload)
        .withColumn("from_end", F.row_number().over(last_first))
        .where(F.col("from_end") <= count)
    )
    in_order = W.partitionBy(*SERIES).orderBy(*order)
    recent = F.collect_list(F.struct(*payload)).over(in_order.rowsBetween(-(count - 1), 0))
    return (
        tails.withColumn("recent", recent)
        .where(F.col("from_end") == 1)
        .withColumn("slice", F.lead("slice").over(W.partitionBy(*SERIES).orderBy("slice")))
        .where(F.col("slice").isNotNull())
        .select(*SERIES, "slice", F.inline("recent"))
    )


def _split_days(sliced: DataFrame) -> DataFrame:
    """Means of the (sensor, type, date) groups that a cut divides, as a staged table."""
    own = _own_value(sliced)
    parts = sliced.groupBy(*SERIES, "date", "slice").agg(F.sum(own).alias("s"), F.count(own).alias("c"))
    whole = (
        parts.groupBy(*SERIES, "date")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("s").alias("s"), F.sum("c").alias("c"))
        .where("parts > 1")
    )
    return stage(
        whole.select(*SERIES, "date", F.try_divide("s", "c").alias("split_day_avg")), "split-days"
    )


def _sliced(
    df: DataFrame, cfg: PipelineConfig, wanted: tuple[str, ...], order: list[str], slices: int
) -> DataFrame:
    cut = cut_into_slices(df, SERIES + order, slices)
    carry = _carry_rows(cut, order, max(cfg.rolling_rows - 1, 1)).withColumn("carried", F.lit(True))
    rows = cut.withColumn("carried", F.lit(False))
    if "daily_avg_value" in wanted:
        rows = rows.join(_split_days(cut), [*SERIES, "date"], "left")
    both = rows.unionByName(carry, allowMissingColumns=True)

    fields = _sequence_fields(W.partitionBy("slice", *SERIES).orderBy(*order), cfg)
    if "daily_avg_value" in wanted:
        here = F.avg(_own_value(both)).over(W.partitionBy("slice", *SERIES, "date"))
        fields["daily_avg_value"] = F.coalesce("split_day_avg", here)
    out = both.withColumns(_pick(fields, wanted)).where(~F.col("carried"))
    return out.drop("slice", "carried", "split_day_avg")


# --- entry points -----------------------------------------------------------


def _large_groups(
    df: DataFrame, key: list[str], limit: int
) -> tuple[DataFrame | None, int]:
    """The keys with more than ``limit`` rows and their row total; (None, 0) if there are none.

    The probe reads the key columns and combines map-side. There are at most total/limit such
    keys; they are staged, so Spark broadcasts them by measured size.
    """
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > limit)
    rows = sizes.agg(F.sum("rows")).first()[0]
    return (stage(sizes, "large-groups"), rows) if rows else (None, 0)


def large_series(df: DataFrame, cfg: PipelineConfig) -> tuple[DataFrame | None, int]:
    """What :func:`series_fields` needs to know about series sizes; any frame with the same rows will do."""
    return _large_groups(df, SERIES, cfg.max_series_rows)


def series_fields(
    df: DataFrame,
    cfg: PipelineConfig,
    wanted: tuple[str, ...] = ALL_FIELDS,
    tiebreak: str | None = None,
    sizes: tuple[DataFrame | None, int] | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Add the wanted neighbour fields, slicing exactly the series that are too large.

    ``sizes`` is the :func:`large_series` of these rows if the caller has it. ``history`` are the last rows of
    earlier batches (series, ordering columns and ``value``): they are neighbours like any other, but take no
    part in day means and are not returned.
    """
    if history is not None:
        sizes = large_series(df, cfg) if sizes is None else sizes
        older = history.select(*SERIES, *total_order(df), "value").withColumn(HISTORIC, F.lit(True))
        both = df.withColumn(HISTORIC, F.lit(False)).unionByName(older, allowMissingColumns=True)
        out = series_fields(both, cfg, wanted, tiebreak, sizes)
        return out.where(~F.col(HISTORIC)).drop(HISTORIC)
    order = total_order(df, tiebreak)
    large, rows = large_series(df, cfg) if sizes is None else sizes
    if large is None:
        return _plain(df, cfg, wanted, order)
    keys = large.select(*SERIES)
    ordinary = _plain(df.join(keys, SERIES, "left_anti"), cfg, wanted, order)
    slices = ceil(rows / cfg.rows_per_slice)
    hot = _sliced(df.join(keys, SERIES, "left_semi"), cfg, wanted, order, slices)
    return ordinary.unionByName(hot.select(*ordinary.columns))


def daily_means(df: DataFrame) -> DataFrame:
    """(date, sensor_id, reading_type, daily_avg_value); combines map-side."""
    return df.groupBy("date", *SERIES).agg(F.avg("value").alias("daily_avg_value"))


def rolling_days(
    df: DataFrame,
    cfg: PipelineConfig,
    out: str = "rolling_days_avg",
    history: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Trailing mean over (t − ``rolling_days``, t] of each series.

    A sliding range frame visits the whole span again for every row. Here the span is the sum
    of three parts, each a running total, so a row costs the same however dense the series:
    the current hour up to the row, the whole hours before it, and the rest of the hour that
    is just leaving the span (seen through copies of its rows moved forward by the span).
    Only rows of one (sensor, type, hour) meet in a task. The input is scanned three times, so
    pass a written frame.

    ``history`` are earlier batches: (hourly sums, rows). The sums (series, ``span_hour``, ``s``, ``c``, ``rows``)
    stand for whole hours; the rows (series, ``timestamp``, ``value``) are needed only where an hour is cut, see
    :func:`cut_hours`.
    """
    if history is not None:
        sums, older = history
        both = df.withColumn(HISTORIC, F.lit(False)).unionByName(
            older.select(*SERIES, "timestamp", "value").withColumn(HISTORIC, F.lit(True)), allowMissingColumns=True
        )
        means = _rolling_days(both, cfg, out, sums)
        return means.where(~F.col(HISTORIC)).drop(HISTORIC)
    return _rolling_days(df, cfg, out, None)


def cut_hours(df: DataFrame, cfg: PipelineConfig) -> list[tuple[datetime, datetime]]:
    """The spans of time whose earlier rows :func:`rolling_days` needs one by one: rows that share an hour with a
    row of ``df``, and rows that leave its span within an hour. None if ``df`` is empty.
    """
    bounds = df.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).first()
    if bounds.low is None:
        return []
    hour, span = timedelta(hours=1), timedelta(days=cfg.rolling_days)
    return [
        (bounds.low - span - hour, bounds.high - span + hour),
        (bounds.low - hour, bounds.high + hour),
    ]


def _rolling_days(df: DataFrame, cfg: PipelineConfig, out: str, older_sums: DataFrame | None) -> DataFrame:
    span_hours = cfg.rolling_days * 24
    span = span_hours * _MICROS_PER_HOUR
    hour_of = lambda us: F.call_function(
        "div", us - F.pmod(us, F.lit(_MICROS_PER_HOUR)), F.lit(_MICROS_PER_HOUR)
    )
    timed = df.withColumn("us", F.unix_micros("timestamp"))
    own = timed.withColumns({"span_hour": hour_of(F.col("us")), "kind": F.lit(0)})
    aged = own.select(
        *SERIES,
        (F.col("us") + span).alias("us"),
        (F.col("span_hour") + span_hours).alias("span_hour"),
        "value",
        F.lit(1).alias("kind"),
    )
    key = [*SERIES, "span_hour"]
    fresh = own if older_sums is None else own.where(~F.col(HISTORIC))
    sums = fresh.groupBy(*key).agg(
        F.sum("value").alias("s"), F.count("value").alias("c"), F.count(F.lit(1)).alias("rows")
    )
    if older_sums is not None:
        merged = sums.unionByName(older_sums.select(*sums.columns)).groupBy(*key)
        sums = merged.agg(*[F.sum(c).alias(c) for c in ("s", "c", "rows")])
    hours = stage(sums, "span-hours")
    earlier = W.partitionBy(*SERIES).orderBy("span_hour").rangeBetween(-(span_hours - 1), -1)
    middle = hours.select(
        *SERIES,
        "span_hour",
        F.sum("s").over(earlier).alias("mid_s"),
        F.sum("c").over(earlier).alias("mid_c"),
    )

    large = hours.where(F.col("rows") > cfg.max_series_rows)
    rows = large.agg(F.sum("rows")).first()[0]
    if not rows:
        return _rolling_plain(own, aged, middle, cfg, out).select(*df.columns, out)
    keys = large.select(*key)
    # An hour is heavy through its own rows or through those that age into it.
    heavy = keys.unionByName(keys.withColumn("span_hour", F.col("span_hour") + span_hours)).distinct()
    heavy = stage(heavy, "heavy-hours")
    light = _rolling_plain(
        own.join(heavy, key, "left_anti"), aged.join(heavy, key, "left_anti"),
        middle.join(heavy, key, "left_anti"), cfg, out,
    )
    dense = _rolling_heavy(
        own.join(heavy, key, "left_semi"), aged.join(heavy, key, "left_semi"),
        middle.join(heavy, key, "left_semi"), cfg, out, ceil(2 * rows / cfg.rows_per_slice),
    )
    return light.select(*df.columns, out).unionByName(dense.select(*df.columns, out))


def _mean_if_enough(total: Column, count: Column, cfg: PipelineConfig) -> Column:
    return F.when(count >= cfg.rolling_min_rows, F.try_divide(total, count))


def _zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def _rolling_plain(own, aged, middle, cfg: PipelineConfig, out: str) -> DataFrame:
    meet = own.unionByName(aged, allowMissingColumns=True).unionByName(
        middle.withColumn("kind", F.lit(2)), allowMissingColumns=True
    )
    hour = W.partitionBy(*SERIES, "span_hour")
    upto = hour.orderBy("us").rangeBetween(W.unboundedPreceding, 0)
    after = hour.orderBy(F.desc("us")).rangeBetween(W.unboundedPreceding, -1)
    current = F.when(F.col("kind") == 0, F.col("value"))
    leaving = F.when(F.col("kind") == 1, F.col("value"))
    total = (
        _zero(F.sum(current).over(upto))
        + _zero(F.sum("mid_s").over(hour))
        + _zero(F.sum(leaving).over(after))
    )
    count = (
        F.count(current).over(upto)
        + _zero(F.sum("mid_c").over(hour))
        + F.count(leaving).over(after)
    )
    return meet.withColumn(out, _mean_if_enough(total, count, cfg)).where("kind = 0")


def _rolling_heavy(own, aged, middle, cfg: PipelineConfig, out: str, slices: int) -> DataFrame:
    """The same for hours too large for one task: slices of instants, then a join back."""
    key = [*SERIES, "span_hour"]
    columns = [*key, "us", "kind", "value"]
    at = lambda kind: F.when(F.col("kind") == kind, F.col("value"))
    # One row per instant: a mass of readings at one instant combines map-side.
    instants = own.select(*columns).unionByName(aged.select(*columns)).groupBy(*key, "us").agg(
        F.sum(at(0)).alias("s0"), F.count(at(0)).alias("c0"),
        F.sum(at(1)).alias("s1"), F.count(at(1)).alias("c1"),
        F.max((F.col("kind") == 0).cast("int")).alias("has_own"),
    )
    cut = cut_into_slices(instants, [*key, "us"], slices)
    sums = cut.groupBy(*key, "slice").agg(*[F.sum(c).alias(c) for c in ("s0", "c0", "s1", "c1")])
    before = W.partitionBy(*key).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    behind = W.partitionBy(*key).orderBy(F.desc("slice")).rowsBetween(W.unboundedPreceding, -1)
    offsets = stage(
        sums.select(
            *key,
            "slice",
            _zero(F.sum("s0").over(before)).alias("s_before"),
            _zero(F.sum("c0").over(before)).alias("c_before"),
            _zero(F.sum("s1").over(behind)).alias("s_behind"),
            _zero(F.sum("c1").over(behind)).alias("c_behind"),
        ).join(middle, key, "left"),
        "slice-offsets",
    )
    piece = W.partitionBy("slice", *key)
    upto = piece.orderBy("us").rowsBetween(W.unboundedPreceding, 0)
    after = piece.orderBy(F.desc("us")).rowsBetween(W.unboundedPreceding, -1)
    total = (
        _zero(F.sum("s0").over(upto)) + F.col("s_before") + _zero(F.col("mid_s"))
        + _zero(F.sum("s1").over(after)) + F.col("s_behind")
    )
    count = (
        _zero(F.sum("c0").over(upto)) + F.col("c_before") + _zero(F.col("mid_c"))
        + _zero(F.sum("c1").over(after)) + F.col("c_behind")
    )
    means = (
        cut.join(offsets, [*key, "slice"], "left")
        .withColumn(out, _mean_if_enough(total, count, cfg))
        .where("has_own = 1")
        .select(*key, "us", out)
    )
    return own.join(means, [*key, "us"], "left")
