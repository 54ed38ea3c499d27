"""Parquet sinks, what they wrote, and type narrowing."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline import functions as fx
from loamline.config import PipelineConfig
from loamline.rows import local_frame, one_row
from loamline.sinks.batches import BatchTable, Entry
from loamline.sources.files import list_files, partition_values, read_or_none, schema_check

# --- writing -------------------------------------------------------------------


def write_single(df: DataFrame, path: str, compression: str = "snappy", one_file: bool = False) -> None:
    """Unpartitioned write. ``one_file`` is for small outputs such as reports."""
    if one_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, keys: tuple[str, ...], compression: str = "snappy", whole: bool = False
) -> None:
    """Hive layout, one folder per key tuple; null keys go to the default partition.

    Partitions that occur in ``df`` are replaced; others that the table already has stay, unless
    the ``whole`` folder is to be replaced.
    REBALANCE gathers each partition's rows so it gets few files, and lets adaptive execution
    split a partition that is far larger than the rest over several tasks.
    """
    gathered = df.hint("rebalance", *[F.col(k) for k in keys])
    clustering = [c for c in ("sensor_id", "reading_type", "timestamp") if c in df.columns]
    clustering = [*keys, *[c for c in clustering if c not in keys]]
    (
        gathered.sortWithinPartitions(*clustering)
        .write.mode("overwrite")
        .option("compression", compression)
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def partition_keys(
    df: DataFrame, cfg: PipelineConfig, partition_by: tuple[str, ...] | None = None
) -> tuple[str, ...]:
    """The keys a load will use: none when some key column is absent."""
    keys = cfg.partition_by if partition_by is None else partition_by
    return tuple(keys) if all(k in df.columns for k in keys) else ()


def load(
    df: DataFrame,
    path: str,
    cfg: PipelineConfig,
    partition_by: tuple[str, ...] | None = None,
    compression: str | None = None,
    batch: str | None = None,
    narrowed: bool = False,
) -> str:
    """Partitioned when every key column is there, else a plain write. Returns the folder written.

    With a ``batch`` the rows become a version of that batch in a table of batches (see
    :mod:`loamline.sinks.batches`), written aside and published at the end: it replaces exactly what an earlier
    load of that batch wrote, and batches never touch each other's rows, even where they share a partition value. With ``narrowed`` columns are stored as narrow as the batch
    allows (see :func:`narrow_plan`); double → float loses digits.
    """
    keys = partition_keys(df, cfg, partition_by)
    if batch is not None:
        table = BatchTable(df.sparkSession, path)
        entry = write_version(df, table, batch, cfg, partition_by, compression, narrowed)
        table.publish(batch, entry)
        return table.folder(batch, entry.version)
    if narrowed:
        df = narrow(df, narrow_plan(df))
    codec = compression or cfg.compression
    if keys:
        write_partitioned(df, path, keys, codec)
    else:
        write_single(df, path, codec)
    return path


def write_version(
    df: DataFrame,
    table: BatchTable,
    batch: str,
    cfg: PipelineConfig,
    partition_by: tuple[str, ...] | None = None,
    compression: str | None = None,
    narrowed: bool = False,
) -> Entry:
    """Write a new version of a batch aside; readers see it once it is published.

    A write that fails leaves nothing behind, and the published version as it is.
    """
    keys = partition_keys(df, cfg, partition_by)
    if narrowed:
        df = narrow(df, narrow_plan(df))
    entry = Entry(table.new_version(), dict(df.dtypes), list(keys))
    folder, codec = table.folder(batch, entry.version), compression or cfg.compression
    try:
        if keys:
            write_partitioned(df, folder, keys, codec, whole=True)
        else:
            write_single(df, folder, codec)
    except BaseException:
        table.discard(batch, entry.version, [])
        raise
    return entry


def read_back(spark: SparkSession, path: str, schema: T.StructType, narrowed: bool = False) -> DataFrame:
    """A written table with its original column types, partition columns included.

    A table of batches is read by its manifest, each batch with the types it was stored with. Other paths to which
    only empty frames were written read as an empty frame; a ``narrowed`` one is read with its stored types
    and widened.
    """
    table = BatchTable(spark, path)
    if table.published:
        return table.read(schema)
    reader = spark.read if narrowed else spark.read.schema(schema)
    found = read_or_none(lambda: reader.parquet(path))
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def stored_batches(spark: SparkSession, path: str) -> list[str]:
    """The names of a table's published batches."""
    return sorted(BatchTable(spark, path).entries())


@dataclass(frozen=True)
class Loaded:
    """One frame of several: where it went, or why it did not."""

    path: str
    error: str | None

    @property
    def success(self) -> bool:
        return self.error is None


def load_batches(
    frames: list[DataFrame], base: str, cfg: PipelineConfig, at_once: int = 4, **options
) -> list[Loaded]:
    """Each frame to ``<base>_part_NNN.parquet``, ``at_once`` of them at a time.

    A frame that fails leaves the others alone; its error is in its row of the result.
    """
    def one(numbered: tuple[int, DataFrame]) -> Loaded:
        number, frame = numbered
        path = f"{base}_part_{number:03d}.parquet"
        try:
            load(frame, path, cfg, **options)
        except Exception as e:  # the caller sees every outcome
            return Loaded(path, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}")
        return Loaded(path, None)

    if not frames:
        return []
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return list(pool.map(one, enumerate(frames)))


# --- what was written ----------------------------------------------------------


def partition_manifest(df: DataFrame, base: str, keys: list[str]) -> DataFrame:
    """(path, rows): the folder each key tuple belongs to; slashes in values become ``_``."""
    part = lambda k: F.concat(
        F.lit(f"{k}="), F.regexp_replace(F.col(k).cast("string"), r"[/\\]", "_")
    )
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.concat_ws("/", F.lit(base), *[part(k) for k in keys]).alias("path"), "rows")
    )


def compression_ratio(size: Column, rows: Column, columns: Column) -> Column:
    """Percent saved against eight bytes per cell; negative when the file is larger."""
    return (F.lit(1.0) - F.try_divide(size, rows * columns * 8)) * 100


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]+$", "")


_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def files_of_partitions(listing: DataFrame, written: DataFrame) -> DataFrame:
    """The listed files that lie in the partitions named by ``written`` (distinct key tuples)."""
    values = partition_values(F.col("path"))
    keys = written.columns
    named = written.select(
        *[F.coalesce(F.col(k).cast("string"), F.lit(_NULL_PARTITION)).alias(f"_{k}") for k in keys]
    )
    escaped = lambda k: F.replace(values[k], F.lit("+"), F.lit("%2B"))
    spelled = listing.withColumns({f"_{k}": F.url_decode(escaped(k)) for k in keys})
    return spelled.join(named, [f"_{k}" for k in keys], "left_semi").drop(*[f"_{k}" for k in keys])


def load_stats(
    spark: SparkSession,
    path: str,
    columns: int,
    rows: DataFrame,
    written: DataFrame | None = None,
) -> DataFrame:
    """One row about a written table; ``rows`` is a one-row count (``records_loaded``).

    ``written`` restricts the files to the partitions of one load into a larger table.
    """
    listing = list_files(spark, path, recursive=True)
    if written is not None:
        listing = files_of_partitions(listing, written)
    written = listing.agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("size"),
        F.count_distinct(_folder(F.col("path"))).alias("partition_count"),
    )
    return one_row(written, rows).select(
        "records_loaded",
        F.lit(path).alias("output_path"),
        fx.megabytes(F.col("size")).alias("file_size_mb"),
        "partition_count",
        compression_ratio(F.col("size"), F.col("records_loaded"), F.lit(columns)).alias(
            "compression_ratio"
        ),
    )


def batch_totals(spark: SparkSession, loaded: list[Loaded]) -> DataFrame:
    """One row over several loads: tables, records, megabytes, mean of the positive ratios, and how
    many loads succeeded and failed. Failed loads count nowhere else.

    One listing and one pass over the footers, however many loads there are.
    """
    good = [b.path for b in loaded if b.success]
    failed = sum(not b.success for b in loaded)
    if not good:
        ddl = (
            "total_files bigint, total_records bigint, total_size_mb double, "
            "average_compression_ratio double, successful_batches bigint, failed_batches bigint"
        )
        return local_frame(spark, [(0, 0, 0.0, 0.0, 0, failed)], ddl)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listing = reader.option("pathGlobFilter", "*.parquet").load(good).select("path", "length", "modificationTime")
    # A footer lacks the partition columns, which the path below the load has.
    part = F.regexp_extract("path", _PART, 1)
    keys = F.size(partition_values(_folder(F.regexp_extract("path", _PART, 2))))
    files = schema_check(listing).groupBy(part.alias("part")).agg(
        F.sum("length").alias("size"),
        F.sum("num_rows").alias("rows"),
        F.max(F.size("actual") + keys).alias("columns"),
    )
    named = local_frame(spark, [(path.rstrip("/").rsplit("/", 1)[1],) for path in good], "part string")
    ratio = compression_ratio(F.col("size"), F.col("rows"), F.col("columns"))
    return named.join(files, "part", "left").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(fx.megabytes(F.col("size"))), F.lit(0.0)).alias("total_size_mb"),
        F.coalesce(F.avg(F.when(ratio > 0, ratio)), F.lit(0.0)).alias("average_compression_ratio"),
        F.count(F.lit(1)).alias("successful_batches"),
        F.lit(failed).cast("bigint").alias("failed_batches"),
    )


# The load that a file belongs to, and the file's place in it.
_PART = r"/([^/]+_part_\d{3,}\.parquet)(/.*)$"


def batch_errors(spark: SparkSession, loaded: list[Loaded]) -> DataFrame:
    """(output_path, error) of the loads that failed."""
    return local_frame(spark, [(b.path, b.error) for b in loaded if not b.success], "output_path string, error string")


def storage_summary(spark: SparkSession, path: str) -> DataFrame:
    """One row: files, megabytes, records and last modification below a path.

    Records are counted with an empty projection, which Parquet answers from its footers.
    """
    listing = list_files(spark, path, recursive=True).agg(
        F.count(F.lit(1)).alias("total_files"),
        fx.megabytes(F.coalesce(F.sum("length"), F.lit(0))).alias("total_size_mb"),
        F.max("modificationTime").alias("last_modified"),
    )
    records = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("total_records"))
    return one_row(listing, records)


def partition_info(spark: SparkSession, path: str) -> DataFrame:
    """(column, value, files): the distinct partition values below a path.

    One row per value, because a table may hold any number of them.
    """
    root = path.rstrip("/") + "/"
    listing = list_files(spark, path, recursive=True)
    below = F.substring_index(F.col("path"), root, -1)
    return (
        listing.select(
            F.explode(partition_values(_folder(F.concat(F.lit("/"), below)))).alias(
                "column", "value"
            )
        )
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("files"))
    )


# --- narrowing -----------------------------------------------------------------

_SKETCH_ERROR = 0.02
_FLOAT_LIMIT = 3.4e38


def narrow_plan(df: DataFrame) -> DataFrame:
    """(column, from_type, to_type) for the columns that can be stored narrower.

    One pass over the data. Distinct counts of text columns are sketched first; only when a
    sketch is within ten standard errors of the one-half limit is that column counted exactly. So
    the choice for a text column is approximate: it errs with the (negligible) probability that a
    sketch is off by more. It never changes values.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.approx_count_distinct(c, _SKETCH_ERROR).alias(f"d{i}"))
        elif isinstance(f.dataType, (T.DoubleType, T.LongType)):
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), F.count(c).alias(f"n{i}")]
    seen = df.agg(*aggs).first()
    rows = []
    for i, f in enumerate(df.schema.fields):
        target = None
        if isinstance(f.dataType, T.StringType) and seen["rows"]:
            if _mostly_repeated(df, f.name, seen[f"d{i}"], seen["rows"]):
                target = "dictionary"
        elif isinstance(f.dataType, T.DoubleType) and seen["rows"]:
            full = seen[f"n{i}"] == seen["rows"]
            if full and seen[f"lo{i}"] >= -_FLOAT_LIMIT and seen[f"hi{i}"] <= _FLOAT_LIMIT:
                target = "float"
        elif isinstance(f.dataType, T.LongType) and seen[f"n{i}"] == seen["rows"] > 0:
            low, high = seen[f"lo{i}"], seen[f"hi{i}"]
            if -(2**15) <= low and high < 2**15:
                target = "smallint"
            elif -(2**31) <= low and high < 2**31:
                target = "int"
        if target:
            rows.append((f.name, f.dataType.simpleString(), target))
    return local_frame(df.sparkSession, rows, "column string, from_type string, to_type string")


def _mostly_repeated(df: DataFrame, name: str, sketched: int, rows: int) -> bool:
    # Ten standard errors decide; anything closer is counted exactly.
    if abs(sketched - rows / 2) > 10 * _SKETCH_ERROR * max(sketched, sqrt(rows)):
        return sketched < rows / 2
    return df.agg(F.count_distinct(name)).first()[0] < rows / 2


def narrow(df: DataFrame, plan: DataFrame) -> DataFrame:
    """Apply a plan. Lossy for double → float. Dictionaries are the writer's own business."""
    # One row per column of the frame.
    casts = {r["column"]: r["to_type"] for r in plan.where("to_type <> 'dictionary'").collect()}
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])
