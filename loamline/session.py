"""Session settings this package relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings only; memory and parallelism stay with the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Partition values such as sensor "001" must come back as written.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Rows of documents are large: smaller batches keep the Python workers' memory low.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Nanosecond timestamps, which Spark has no type for, are read as whole numbers and scaled.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set this package's runtime settings in the caller's session, for good, and ship the package."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever the driver was started; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="loamline-package-"), "loamline-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


# Bytes a shuffle partition should hold while there are few, and where there are many: with more
# reducers than this the status of every map task outgrows the driver, so partitions grow instead
# (they spill) up to MANY_BYTES, and beyond MAX_PARTITIONS without limit.
FEW_BYTES = 128 * 1024 * 1024
MANY_BYTES = 1024 * 1024 * 1024
FEW_PARTITIONS = 2_000
MAX_PARTITIONS = 20_000
# Five narrow columns: the shuffled rows are about twice their stored size.
SHUFFLED_GROWTH = 2


def shuffle_partitions(stored_bytes: int) -> int:
    """How many partitions the shuffles over this much stored input should have."""
    shuffled = stored_bytes * SHUFFLED_GROWTH
    few = -(-shuffled // FEW_BYTES)
    if few <= FEW_PARTITIONS:
        return max(1, few)
    return min(MAX_PARTITIONS, max(FEW_PARTITIONS, -(-shuffled // MANY_BYTES)))


@contextmanager
def sized_shuffles(spark: SparkSession, stored_bytes: int):
    """Within the block, shuffles have at least ``shuffle_partitions``; afterwards the setting is as before.

    The count is only ever raised: adaptive execution merges partitions that turn out small, but
    cannot split one that no skew rule applies to. Plans made inside keep the count if they run
    inside.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(shuffle_partitions(stored_bytes), int(before))))
    try:
        yield int(spark.conf.get(key))
    finally:
        spark.conf.set(key, before)


@contextmanager
def tidy_shuffles(spark: SparkSession):
    """Within the block, the shuffle files of each query are deleted when it ends, not when the driver collects
    garbage. For chains of written tables, whose plans run once; a frame that is to run twice belongs outside.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(cpus: int | None = None, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loamline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        # Call-site capture costs more than the calls when plans are built from many columns.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
