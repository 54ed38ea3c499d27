"""The landing folder: listing, date windows, footers, per-file statistics.

A day of readings is ``<dir>/YYYY-MM-DD.parquet`` — one file, or the folder of
part files a Spark writer leaves under that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loamline import functions as fx
from loamline.rows import local_frame
from loamline.sources.readings import (
    READING_COLUMNS,
    READING_TYPES,
    keep_spelling,
    normalise,
    stored_present,
    union_readings,
)
from loamline.session import ship_package
from loamline.staging import stage

LISTING_SCHEMA = "path string, length bigint, modificationTime timestamp"
_DAY_IN_PATH = r"/(\d{4}-\d{2}-\d{2})\.parquet(?:/[^/]+)?$"


def read_or_none(load):
    """Run a reader; None when there is nothing to read at the path."""
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def list_files(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """(path, length, modificationTime) of the Parquet files, sorted by path.

    The listing reads no file content: the ``content`` column is pruned.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        found = read_or_none(lambda: reader.load(directory))
    else:
        found = read_or_none(lambda: reader.load(f"{directory.rstrip('/')}/*.parquet"))
    if found is None:
        return local_frame(spark, [], LISTING_SCHEMA)
    return found.select("path", "length", "modificationTime").orderBy("path")


def day_of_path(path: Column) -> Column:
    """The date in a file name, null when the name holds no valid date."""
    return F.try_to_date(F.regexp_extract(path, _DAY_IN_PATH, 1), "yyyy-MM-dd")


def in_date_window(path: Column, start: str | None, end: str | None) -> Column | None:
    """Inclusive date-name window; None when no bound is given (every file)."""
    if start is None and end is None:
        return None
    day = day_of_path(path)
    inside = day.isNotNull()
    if start is not None:
        inside = inside & (day >= F.to_date(F.lit(start)))
    if end is not None:
        inside = inside & (day <= F.to_date(F.lit(end)))
    return inside


def files_in_window(
    spark: SparkSession, directory: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The listing restricted to files whose name falls in the window."""
    listing = list_files(spark, directory)
    inside = in_date_window(F.col("path"), start, end)
    return listing if inside is None else listing.where(inside)


def read_window(
    spark: SparkSession,
    directory: str,
    start: str | None = None,
    end: str | None = None,
    schema=None,
) -> DataFrame:
    """Readings of the files in the window.

    The predicate is on file metadata, so excluded files are pruned at listing
    time and never opened. Without a ``schema`` it comes from the footer of the
    window's first readable file, never from a file outside of the window.
    """
    if schema is None:
        schema = window_schema(spark, directory, start, end)
    df = spark.read.schema(schema).parquet(f"{directory.rstrip('/')}/*.parquet")
    inside = in_date_window(F.col("_metadata.file_path"), start, end)
    return df if inside is None else df.where(inside)


def window_schema(spark: SparkSession, directory: str, start: str | None, end: str | None) -> str:
    """DDL of the first file, by path, of the window whose footer can be read, else the declared one."""
    checked = schema_check(files_in_window(spark, directory, start, end)).where("actual IS NOT NULL")
    first = checked.agg(F.min_by("actual", "path").alias("actual")).first()
    if first is None or first.actual is None:
        return ", ".join(f"{name} {kind}" for name, kind in READING_TYPES.items())
    return ", ".join(f"`{name}` {spark_type(kind) or 'string'}" for name, kind in first.actual.items())


def partition_values(path: Column) -> Column:
    """``col=value`` segments of a path as a map; a repeated column keeps the last."""
    segments = F.filter(F.split(path, "/"), lambda s: s.contains("="))
    entries = F.transform(
        segments,
        lambda s: F.struct(
            F.substring_index(s, "=", 1).alias("key"),
            F.regexp_replace(s, "^[^=]*=", "").alias("value"),
        ),
    )
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
    return F.map_from_arrays(keys, F.transform(keys, last))


# --- footers ---------------------------------------------------------------

_FOOTER_SCHEMA = (
    "path string, length bigint, actual map<string,string>, num_rows bigint, error string"
)


# Schemes that the footer reader's file systems know under another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs", "wasb": "abfs", "dbfs": "file"}


def footer_location(path: str) -> str:
    """A listed path as the footer reader's file systems spell it.

    ``dbfs:`` paths are read through the mount every node of such a cluster has at /dbfs.
    """
    from urllib.parse import quote

    scheme, colon, rest = path.partition(":")
    if not colon:
        return "file://" + quote(path)
    if scheme == "file":
        return "file:///" + quote(rest.lstrip("/"))
    if scheme == "dbfs":
        return "file:///dbfs/" + quote(rest.lstrip("/"))
    return f"{_SCHEMES.get(scheme, scheme)}:{quote(rest, safe=':/@')}"


def footer_system(path: str):
    """(file system, path in it); raises for a store that footers cannot be read from here.

    That is a fault of the installation, not of the file, so it must not condemn files.
    """
    from pyarrow import fs

    try:
        return fs.FileSystem.from_uri(footer_location(path))
    except Exception as e:
        raise RuntimeError(f"footers cannot be read from {path.split(':')[0]}: stores here: {e}") from e


INT96 = "timestamp[int96]"


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parquet footers of the listed files; runs on executors, reads no data pages."""
    import pyarrow.parquet as pq

    for batch in batches:
        out = []
        for path, length in zip(batch["path"], batch["length"]):
            row = {"path": path, "length": length, "actual": None, "num_rows": None, "error": None}
            system, inner = footer_system(path)
            try:
                with system.open_input_file(inner) as handle:
                    meta = pq.ParquetFile(handle)
                    stored = meta.metadata.schema
                    columns = [stored.column(i) for i in range(len(stored))]
                    # The old 96-bit form of instants is not the 64-bit form of nanoseconds.
                    old = {c.path for c in columns if c.physical_type == "INT96"}
                    row["actual"] = {f.name: INT96 if f.name in old else str(f.type) for f in meta.schema_arrow}
                    row["num_rows"] = meta.metadata.num_rows
            except Exception as e:  # any unreadable file is a finding, not a failure
                row["error"] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
            out.append(row)
        yield pd.DataFrame(out, columns=["path", "length", "actual", "num_rows", "error"])


# How the footer reader spells a stored type, and the type the scan reads it as.
_READ_AS = {
    "string": "string", "large_string": "string", "bool": "boolean", "double": "double", "float": "float",
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "date32[day]": "date",
    "uint8": "smallint", "uint16": "int", "uint32": "bigint", "binary": "binary", "large_binary": "binary",
}
NANOS = "bigint"  # nanoseconds are read as whole numbers and scaled


def spark_type(stored: str) -> str | None:
    """The type to read a stored column as; None when the scan cannot read it."""
    stored = re.sub(r"^dictionary<values=([^,]+),.*>$", r"\1", stored)
    if stored == INT96:
        return "timestamp"
    if stored.startswith("timestamp[ns"):
        return NANOS
    if stored.startswith("timestamp[us") or stored.startswith("timestamp[ms"):
        return "timestamp" if "tz=" in stored else "timestamp_ntz"
    if re.fullmatch(r"decimal128\(\d+, \d+\)", stored):
        return stored.replace("decimal128", "decimal")
    return _READ_AS.get(stored)


def schema_check(listing: DataFrame) -> DataFrame:
    """(path, length, actual, missing, num_rows, is_valid, error), one row per listed file."""
    spark = listing.sparkSession
    ship_package(spark)
    # Footer reads are latency-bound: spread the paths over all slots.
    slots = spark.sparkContext.defaultParallelism * 4
    footers = (
        listing.select("path", "length")
        .repartition(slots, "path")
        .mapInPandas(_read_footers, _FOOTER_SCHEMA)
    )
    expected = F.array(*[F.lit(c) for c in READING_COLUMNS])
    missing = F.array_except(expected, F.coalesce(F.map_keys("actual"), F.array().cast("array<string>")))
    return footers.select(
        "path",
        "length",
        "actual",
        F.when(F.col("error").isNull(), missing).alias("missing"),
        "num_rows",
        (F.col("error").isNull() & (F.size(missing) == 0)).alias("is_valid"),
        "error",
    )


# --- per-file statistics and quarantine ------------------------------------


def _metadata_file() -> Column:
    """The scanned file's path spelled as the listing spells it."""
    encoded = F.col("_metadata.file_path")
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def count_by_file(scanned: DataFrame) -> DataFrame:
    """(file, records_total, records_valid) of a scan with a ``file`` and a ``present`` column."""
    return scanned.groupBy("file").agg(
        F.count(F.lit(1)).alias("records_total"), F.count_if("present").alias("records_valid")
    )


def file_stats(checked: DataFrame, scanned: DataFrame | None) -> DataFrame:
    """One row per checked file: size, record counts, schema verdict, errors.

    ``checked`` is the output of :func:`schema_check`; ``scanned`` the rows of its valid files
    (None when there are none). Broken and empty files stay, with zero counts.
    """
    if scanned is None:
        total = valid = F.lit(0).cast("bigint")
        joined = checked
    else:
        counted = count_by_file(scanned).withColumnRenamed("file", "path")
        joined = checked.join(counted, "path", "left")
        total = F.coalesce("records_total", F.lit(0))
        valid = F.coalesce("records_valid", F.lit(0))
    prefix = F.lit("Schema validation failed: ")
    errors = F.array_compact(
        F.array(
            F.when(F.col("error").isNotNull(), F.concat(prefix, "error")),
            F.when(
                F.size("missing") > 0,
                F.concat(prefix, F.lit("missing columns "), F.array_join("missing", ", ")),
            ),
            F.when(F.col("is_valid") & (total == 0), F.lit("File is empty")),
        )
    )
    return joined.select(
        F.col("path").alias("file_path"),
        fx.megabytes(F.col("length")).alias("file_size_mb"),
        total.alias("records_total"),
        valid.alias("records_valid"),
        (total - valid).alias("records_invalid"),
        F.col("is_valid").alias("schema_valid"),
        (F.col("is_valid") & (total > 0)).alias("success"),
        errors.alias("errors"),
    )


def scan_checked(
    spark: SparkSession,
    directory: str,
    checked: DataFrame,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame | None:
    """Normalised readings of the valid files, with ``file`` and ``present`` columns.

    Days may store the same column under different physical types, so valid files are scanned
    once per type signature, each time with an explicit schema. Days all of whose files have one signature are
    scanned by Spark, with a predicate on file metadata: other files are pruned at listing time. The files of
    days that are mixed — some in quarantine or of another signature — are read from the table of checked
    files by the tasks, one file at a time. So no path passes the driver, only one row per day and signature.
    """
    good = checked.where("is_valid").withColumn("signature", _signature())
    signatures = [r.signature for r in good.select("signature").distinct().collect()]
    frames = []
    for signature in sorted(signatures):
        kinds = dict(zip(READING_COLUMNS, signature.split(_BETWEEN)))
        schema = ", ".join(f"`{c}` {spark_type(kind)}" for c, kind in kinds.items())
        whole, mixed = _days_of(checked.withColumn("signature", _signature()), signature)
        raw = None
        if whole is not None:
            scan = spark.read.schema(schema).parquet(f"{directory.rstrip('/')}/*.parquet").where(whole)
            raw = scan.select("*", _metadata_file().alias("file"))
        odd = good.where((F.col("signature") == signature) & mixed)
        if not odd.isEmpty():
            own = read_files(odd, schema)
            raw = own if raw is None else raw.unionByName(own)
        # Presence is judged on the stored columns, before any conversion.
        present = stored_present(raw)
        if kinds["timestamp"].startswith("timestamp[ns"):
            raw_time = F.timestamp_micros(F.call_function("div", F.col("timestamp"), F.lit(1000)))
        else:
            raw_time = F.col("timestamp")
        stored = [raw_time.alias(c) if c == "timestamp" else F.col(c) for c in READING_COLUMNS]
        kept = keep_spelling(raw.select(*stored, "file", present.alias("present")))
        frames.append(normalise(kept, keep=tuple(c for c in kept.columns if c not in READING_COLUMNS)))
    return union_readings(frames) if frames else None


_BETWEEN = "\u001f"


def _signature() -> Column:
    """The stored types of the reading columns as one text; null for a file that is not valid."""
    kinds = F.concat_ws(_BETWEEN, *[F.try_element_at("actual", F.lit(c)) for c in READING_COLUMNS])
    return F.when(F.col("is_valid"), kinds)


def _days_of(checked: DataFrame, signature: str) -> tuple[Column | None, Column]:
    """(predicate on file metadata, predicate on ``path``) for the files of one signature.

    The first selects the days all of whose checked files have it, as date ranges between the days that other
    checked files have, None if there are none. The second selects files of other days and files without a day.
    """
    mine = F.col("signature").eqNullSafe(F.lit(signature))
    day = day_of_path(F.col("path"))
    days = sorted(
        (str(r.day), r.mine == r.n)
        for r in checked.where(day.isNotNull())
        .groupBy(day.alias("day"))
        .agg(F.count_if(mine).alias("mine"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    found, ranges = day_of_path(F.col("_metadata.file_path")), []
    for whole, run in groupby(days, key=lambda d: d[1]):
        run = list(run)
        if whole:
            ranges.append((run[0][0], run[-1][0]))
    between = lambda c: reduce(
        lambda a, b: a | b, [(c >= F.to_date(F.lit(low))) & (c <= F.to_date(F.lit(high))) for low, high in ranges]
    )
    if not ranges:
        return None, F.lit(True)
    return between(found), F.coalesce(~between(day), F.lit(True))


_ROWS_AT_ONCE = 65_536


def read_files(files: DataFrame, schema: str) -> DataFrame:
    """The rows of the files named in ``path``, as ``schema`` and with their ``file``; each file in one task.

    Exactly these files are opened, whatever lies beside them by now. A file is streamed, so its size does
    not matter to a task's memory.
    """
    spark = files.sparkSession
    ship_package(spark)
    wanted = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        import pyarrow.parquet as pq

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = footer_system(path)
                with system.open_input_file(inner) as handle:
                    stored = pq.ParquetFile(handle)
                    for rows in stored.iter_batches(_ROWS_AT_ONCE, columns=wanted.names):
                        columns = [_stored_as(rows.column(f.name), f.type) for f in wanted]
                        columns.append(pa.array([path] * rows.num_rows, pa.string()))
                        yield pa.RecordBatch.from_arrays(columns, [*wanted.names, "file"])

    slots = spark.sparkContext.defaultParallelism * 4
    return files.select("path").repartition(slots, "path").mapInArrow(run, f"{schema}, file string")


def _stored_as(column: pa.Array, kind: pa.DataType) -> pa.Array:
    """A stored column as the type that a scan gives it: instants are cut to microseconds."""
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    return column.cast(kind, safe=False) if pa.types.is_temporal(column.type) else column.cast(kind)


@dataclass(frozen=True)
class Ingest:
    """What one ingest produced; ``readings`` is None when no file was usable."""

    readings: DataFrame | None
    stats: DataFrame
    quarantined: DataFrame


def check_window(
    spark: SparkSession, directory: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The staged :func:`schema_check` of the files in the window.

    A valid footer with a column type that the scan cannot read puts the file in quarantine too.
    """
    checked = stage(schema_check(files_in_window(spark, directory, start, end)), "schema-check")
    kinds = F.explode(F.map_entries(F.map_filter("actual", lambda k, v: k.isin(*READING_COLUMNS))))
    stored = checked.where("is_valid").select(kinds.alias("e")).select("e.value").distinct().collect()
    unreadable = sorted(r.value for r in stored if spark_type(r.value) is None)
    if not unreadable:
        return checked
    wrong = F.map_filter("actual", lambda k, v: k.isin(*READING_COLUMNS) & v.isin(*unreadable))
    said = F.transform(F.map_entries(wrong), lambda e: F.concat(e["key"], F.lit(" "), e["value"]))
    problem = F.when(
        F.col("is_valid") & (F.cardinality(wrong) > 0),
        F.concat(F.lit("unreadable types "), F.array_join(F.array_sort(said), ", ")),
    )
    return checked.withColumn("error", F.coalesce("error", problem)).withColumn(
        "is_valid", F.col("is_valid") & problem.isNull()
    )


def ingest(
    spark: SparkSession,
    directory: str,
    start: str | None = None,
    end: str | None = None,
    checked: DataFrame | None = None,
) -> Ingest:
    """Check every file of the window, read the good ones, set the bad ones aside.

    ``checked`` is the window's :func:`check_window` if the caller already has it.
    """
    if checked is None:
        checked = check_window(spark, directory, start, end)
    scanned = scan_checked(spark, directory, checked, start, end)
    stats = stage(file_stats(checked, scanned), "file-stats")
    readings = None if scanned is None else scanned.drop("file", "present")
    return Ingest(readings, stats, stats.where(~F.col("success")))


def ingest_summary(stats: DataFrame) -> DataFrame:
    """One row of totals; record counts and megabytes count successful files only.

    Errors stay one row per finding in :func:`ingest_errors`: their number grows with the
    landing folder, so they are counted here and not gathered into this row.
    """
    ok = F.col("success")
    total = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0))
    return stats.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(ok).alias("successful_files"),
        F.count_if(~ok).alias("failed_files"),
        total("records_total").alias("total_records"),
        total("records_valid").alias("valid_records"),
        total("records_invalid").alias("invalid_records"),
        total("file_size_mb").cast("double").alias("total_size_mb"),
        F.coalesce(F.sum(F.when(~ok, F.size("errors"))), F.lit(0)).alias("error_count"),
    )


def ingest_errors(stats: DataFrame) -> DataFrame:
    """(file_path, error): every error of every failed file."""
    return stats.where(~F.col("success")).select("file_path", F.explode("errors").alias("error"))
