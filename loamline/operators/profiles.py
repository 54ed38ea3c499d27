"""Moments and exact medians of groups of any size.

Spark's ``median`` keeps every distinct value of a group in one aggregation buffer, and one
reading type can be a third of a data set. Here the group is narrowed down instead, by counts
that combine map-side and whose number does not depend on the number of rows:

1. a histogram on logarithmic bins gives count, moments and the bin of each middle rank;
2. while that bin is large, a histogram on linear cells within it gives a far smaller one;
3. the few values of that bin are counted per value and ranked.

Every row takes part in the counts and the bins are monotone in the value, so the result is
the exact median. Each step scans the two columns once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamline.staging import stage

BINS_PER_OCTAVE = 128
LINEAR_BINS = 4096
# A bin of at most this many values is ranked directly, without another histogram.
DIRECT_VALUES = 1_000_000
# Above the largest |log2| of a double, so the sign alone decides the side of zero.
_OCTAVES = 1100


def log_bin(value: Column) -> Column:
    """A bin number that never decreases as the value grows; zero has a bin of its own."""
    magnitude = F.floor(F.log2(F.abs(value)) * BINS_PER_OCTAVE) + _OCTAVES * BINS_PER_OCTAVE
    beyond = 2 * _OCTAVES * BINS_PER_OCTAVE
    magnitude = F.when(F.abs(value) == float("inf"), F.lit(beyond)).otherwise(magnitude)
    return F.when(value == 0, F.lit(0)).when(value > 0, magnitude).otherwise(-magnitude).cast("int")


def histogram(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, bin, c, lo, hi, mean, m2) of the non-null values; combines map-side."""
    v = F.col(value)
    return (
        df.where(v.isNotNull())
        .groupBy(key, log_bin(v).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("c"),
            F.min(v).alias("lo"),
            F.max(v).alias("hi"),
            F.avg(v).alias("mean"),
            (F.var_pop(v) * F.count(F.lit(1))).alias("m2"),
        )
    )


def merge_histograms(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """One histogram out of two, e.g. of two batches: bins add up by the pairwise variance rule."""
    same = W.partitionBy(key, "bin")
    mean = F.sum(F.col("c") * F.col("mean")).over(same) / F.sum("c").over(same)
    spread = F.col("m2") + F.col("c") * F.pow(F.col("mean") - F.col("all_mean"), 2)
    return (
        one.unionByName(other)
        .withColumn("all_mean", mean)
        .groupBy(key, "bin")
        .agg(
            F.sum("c").alias("c"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.first("all_mean").alias("mean"),
            F.sum(spread).alias("m2"),
        )
    )


def moments_of(hist: DataFrame, key: str) -> DataFrame:
    """(key, n, mean, m2, min, max) from a histogram, by the pairwise variance rule."""
    total = W.partitionBy(key)
    n = F.sum("c").over(total)
    mean = F.sum(F.col("c") * F.col("mean")).over(total) / n
    spread = F.col("m2") + F.col("c") * F.pow(F.col("mean") - F.col("all_mean"), 2)
    return (
        hist.withColumn("all_mean", mean)
        .groupBy(key)
        .agg(
            F.sum("c").alias("n"),
            F.first("all_mean").alias("mean"),
            F.sum(spread).alias("m2"),
            F.min("lo").alias("min"),
            F.max("hi").alias("max"),
        )
    )


def _holding(counts: DataFrame, by: list[str], order: str, rank: Column) -> DataFrame:
    """Rows of an ordered count table that contain ``rank``, with the rank made local."""
    upto = F.sum("c").over(W.partitionBy(*by).orderBy(order))
    before = F.col("upto") - F.col("c")
    return (
        counts.withColumn("upto", upto)
        .where((before <= rank) & (rank < F.col("upto")))
        .withColumn("local_rank", rank - before)
        .drop("upto")
    )


def _within(df: DataFrame, key: str, value: str, targets: DataFrame, times: str | None) -> DataFrame:
    """(key, rank, local_rank, lo, hi, v, times): the values that fall into a target's bin."""
    v = F.col(value)
    often = F.lit(1).cast("bigint") if times is None else F.col(times)
    return (
        df.select(key, v.alias("v"), often.alias("times"))
        .join(targets.select(key, "rank", "local_rank", "lo", "hi"), key)
        .where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
    )


def medians_of(df: DataFrame, key: str, value: str, hist: DataFrame, times: str | None = None) -> DataFrame:
    """(key, median): exact, from the data and its staged :func:`histogram`.

    A row may stand for several equal values, as many as its column ``times`` says.
    """
    n = F.col("n")
    middle = F.array_distinct(
        F.array(F.call_function("div", n - 1, F.lit(2)), F.call_function("div", n, F.lit(2)))
    )
    counts = hist.withColumn("n", F.sum("c").over(W.partitionBy(key))).withColumn(
        "rank", F.explode(middle)
    )
    by = [key, "rank"]
    # At most two rows per key. Written, so that the join below knows their size and does not
    # shuffle the data on a key that may be hot.
    target = stage(_holding(counts, by, "bin", F.col("rank")), "median-bin")
    # The ends of a bin fall into different cells, so every round makes it smaller.
    while _widest(target) > DIRECT_VALUES:
        target = _refined(df, key, value, target, times)

    values = (
        _within(df, key, value, target, times)
        .groupBy(key, "rank", F.col("local_rank").alias("wanted"), "v")
        .agg(F.sum("times").alias("c"))
    )
    exact = _holding(values, by, "v", F.col("wanted"))
    return exact.groupBy(key).agg(F.avg("v").alias("median"))


def _widest(target: DataFrame) -> int:
    """The largest count of a target that still holds different values."""
    return target.where("lo < hi").agg(F.max("c")).first()[0] or 0


def _refined(df: DataFrame, key: str, value: str, coarse: DataFrame, times: str | None) -> DataFrame:
    """The targets again, each within one of many equal cells of its bin; staged."""
    width = F.col("hi") - F.col("lo")
    share = F.try_divide(F.col("v") - F.col("lo"), width)
    cell = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * LINEAR_BINS), F.lit(LINEAR_BINS - 1))
    cells = (
        _within(df, key, value, coarse, times)
        .groupBy(key, "rank", F.col("local_rank").alias("wanted"), cell.alias("cell"))
        .agg(F.sum("times").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    return stage(_holding(cells, [key, "rank"], "cell", F.col("wanted")), "median-cell")


def group_profile(df: DataFrame, key: str, value: str, medians: bool = True) -> DataFrame:
    """(key, n, mean, m2, min, max, median) of the non-null values of each key, staged."""
    hist = stage(histogram(df, key, value), "histogram")
    moments = moments_of(hist, key)
    if medians:
        moments = moments.join(medians_of(df, key, value, hist), key, "left")
    return stage(moments, "profile")


def profile_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, std, min, max, median, missing_count, missing_pct) per column.

    ``std`` is the sample deviation. Absent columns are skipped. All columns go through the
    same passes, as one long (column, value) relation.
    """
    present = [c for c in columns if c in df.columns]
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
            for c in present
        ]
    )
    long = df.select(F.inline(pairs))
    stats = group_profile(long, "column", "value")
    missing = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("missing_count")
    )
    return missing.join(stats, "column", "left").select(
        "column",
        F.coalesce("n", F.lit(0)).alias("count"),
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1))).alias("std"),
        "min",
        "max",
        "median",
        "missing_count",
        (F.col("missing_count") * 100.0 / F.col("rows")).alias("missing_pct"),
    )
