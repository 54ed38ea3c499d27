"""Per-type statistics and z-score outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.config import PipelineConfig
from loamline.operators.profiles import group_profile
from loamline.staging import stage


def type_moments(df: DataFrame, approx: bool = False) -> DataFrame:
    """(reading_type, n, mean, std, median) of the non-null values, as a staged table.

    ``std`` is the population deviation. ``approx`` trades the exact median for a sketch and
    needs a single scan.
    """
    if approx:
        return stage(
            df.groupBy("reading_type").agg(
                F.count("value").alias("n"),
                F.avg("value").alias("mean"),
                F.stddev_pop("value").alias("std"),
                F.percentile_approx("value", 0.5).alias("median"),
            ),
            "type-moments",
        )
    return group_profile(df, "reading_type", "value").select(
        "reading_type", "n", "mean", F.sqrt(F.col("m2") / F.col("n")).alias("std"), "median"
    )


def _is_outlier(cfg: PipelineConfig) -> Column:
    z = F.abs(F.try_divide(F.col("value") - F.col("mean"), F.col("std")))
    flagged = (F.col("n") > cfg.min_rows_for_outliers) & (z > cfg.z_score_threshold)
    return F.coalesce(flagged, F.lit(False))


def flag_outliers(df: DataFrame, moments: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Add a non-null ``is_outlier``; rows and values stay as they are.

    ``moments`` is a staged table, so the join is a broadcast exactly when its measured size
    allows it, and a skew-handled sort-merge join otherwise.
    """
    joined = df.join(moments.select("reading_type", "n", "mean", "std"), "reading_type", "left")
    return joined.withColumn("is_outlier", _is_outlier(cfg)).drop("n", "mean", "std")


def replace_outliers(df: DataFrame, moments: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Flag outliers and put the type's median in their place; no row is removed.

    ``source_value`` keeps the value from before, which the time order needs for ties.
    """
    return (
        df.join(moments, "reading_type", "left")
        .withColumn("is_outlier", _is_outlier(cfg))
        .withColumn("source_value", F.col("value"))
        .withColumn("value", F.when(F.col("is_outlier"), F.col("median")).otherwise(F.col("value")))
        .drop("n", "mean", "std", "median")
    )
