"""Input tables and the small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(id_col: str, buckets: int):
    """crc32 of the id as text, modulo ``buckets``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(buckets)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batch, rows: int):
    """An Arrow batch in pieces of at most ``rows`` rows, so that Python lists stay small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
