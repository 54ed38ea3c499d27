"""Small frames."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few driver-side rows as a local relation: no job, and a size Spark knows exactly.

    (A frame made from a Python list would be spread over the whole cluster's slots.)
    """
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def unit(spark: SparkSession) -> DataFrame:
    """One row in one partition, to hang literals on."""
    return spark.range(0, 1, 1, 1)


def one_row(*singles: DataFrame) -> DataFrame:
    """The columns of several one-row frames in one row."""
    names = [c for df in singles for c in df.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), singles)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])
